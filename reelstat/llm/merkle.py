"""Merkle manifest of a dataset: one tree over all documents, and a version of it for every tampered one.

The tree is cut into aligned blocks of ``3**BLOCK_LEVELS`` nodes, each worked off whole by one task; the blocks' top nodes are the
nodes of the next layer of blocks, until one node is left for each source, and the same again over the sources. On the way
down every block gets the siblings of its top node in the blocks above.

A version is a persistent tree: it shares all nodes with the original but the ancestors of its leaf, which are copied within the
leaf's block and then along the upper blocks. Only the copies are computed and held, so versions cost their depth, and since a
block knows its upper siblings, they go on upwards where they began: no upper block gathers the versions below it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.ranking import ranked
from reelstat.llm.storage import Scratch, materialise

FAN = 3
BLOCK_LEVELS = 6
BLOCK = FAN**BLOCK_LEVELS
LEAF = ("doc_id", "source", "lang", "n_chars", "text")

#: Siblings of a node on one level: those left of it and those right of it, each as one text.
Siblings = tuple[str, str]


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class Block:
    """The part of the tree above some consecutive nodes, whose first one starts a block.

    The only block of a tree ends with one node; a block with others beside it has all levels, however few nodes it has. Only a tree's
    first block can be the only one, and it is full if others follow.
    """

    def __init__(self, number: int, nodes: Sequence[str]):
        self.levels = [list(nodes)]
        whole = number > 0 or len(nodes) == BLOCK
        while len(self.levels) <= BLOCK_LEVELS if whole else len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, at: int) -> list[Siblings]:
        """The siblings of a node and of its ancestors up to the top."""
        out = []
        for level in self.levels[:-1]:
            run = at - at % FAN
            out.append(("".join(level[run:at]), "".join(level[at + 1 : run + FAN])))
            at //= FAN
        return out


def copied(node: str, path: Sequence[Siblings]) -> list[str]:
    """The ancestors of a changed node along its path: the nodes that its version does not share."""
    out = []
    for left, right in path:
        node = digest(left + node + right)
        out.append(node)
    return out


def leaf(columns: dict[str, Column]) -> Column:
    """A document's digest: for each column ``-`` if null, else its UTF-8 length, a colon and its value."""
    texts = [c.cast("string") for c in columns.values()]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def without_breaks(docs: DataFrame) -> Column:
    """The tampering of the check: where 2 divides the crc32 of the id, the text without its line breaks; null elsewhere."""
    return F.when(F.crc32(docs["doc_id"].cast("string")) % 2 == 0, F.translate(docs["text"], "\n", ""))


def _gathered(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Rows (tree, at, digest, payload) as one row for each block, with the nodes in order; a block is bounded."""
    rows = F.array_sort(F.collect_list(F.struct("at", "digest", *payload)))
    blocks = nodes.groupBy("tree", F.expr(f"at div {BLOCK}").alias("block")).agg(rows.alias("rows"))
    return blocks.select("tree", "block", *[F.col(f"rows.{c}").alias(c) for c in ("digest", *payload)])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trees, at, tops = [], [], []
    for row in _rows(batches):
        trees.append(row["tree"])
        at.append(row["block"])
        tops.append(Block(row["block"], row["digest"]).top)
    yield pa.RecordBatch.from_arrays([pa.array(trees, pa.string()), pa.array(at, pa.int64()), pa.array(tops, pa.string())], ["tree", "at", "digest"])


def _climbed(blocks: DataFrame, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """The layers of blocks from the lowest, and the last node (tree, digest) of each tree."""
    layers = [blocks]
    while True:
        plain = layers[-1].select("tree", "block", "digest")
        tops = scratch.keep(plain.mapInArrow(_tops, "tree string, at long, digest string"), "tops")
        if not tops.agg(F.max("at")).first()[0]:
            return layers, tops.select("tree", "digest")
        layers.append(scratch.keep(_gathered(tops), "blocks"))


PATH = "path array<struct<before: string, after: string>>, subroot string, root string"
_PATH_ARROW = [pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])), pa.string(), pa.string()]


def _upper(row: dict) -> list[Siblings]:
    return [(s["before"], s["after"]) for s in row["path"]]


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tree, at, path, subroot, root) of the nodes of each block, which are the tops of the blocks below."""
    kinds = [pa.string(), pa.int64(), *_PATH_ARROW]
    for row in _rows(batches):
        block, upper = Block(row["block"], row["digest"]), _upper(row)
        n = len(row["digest"])
        paths = [[{"before": a, "after": b} for a, b in [*block.path(i), *upper]] for i in range(n)]
        at = range(row["block"] * BLOCK, row["block"] * BLOCK + n)
        arrays = [[row["tree"]] * n, at, paths, [row["subroot"]] * n, [row["root"]] * n]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(arrays, kinds, strict=True)], ["tree", "at", "path", "subroot", "root"]
        )


def _descended(layers: list[DataFrame], paths: DataFrame, scratch: Scratch) -> DataFrame:
    """The paths of the tops of the lowest layer's blocks, from those of the trees' last nodes (tree, block = 0, ...)."""
    for layer in reversed(layers[1:]):
        below = layer.join(paths, ["tree", "block"]).mapInArrow(_paths, f"tree string, at long, {PATH}")
        paths = scratch.keep(below, "paths").withColumnRenamed("at", "block")
    return paths


def _over_sources(subroots: DataFrame, scratch: Scratch) -> DataFrame:
    """(tree, block = 0, path, subroot, root) of each source's last node in the tree over all sources."""
    order = ranked(subroots.select(F.lit("").alias("all"), "tree", "digest"), "all", ["tree"], "at", scratch)
    nodes = order.select(F.lit("").alias("tree"), "at", "digest", F.col("tree").alias("source"))
    blocks = scratch.keep(_gathered(nodes, ["source"]), "sources")
    layers, root = _climbed(blocks, scratch)
    none = F.array().cast("array<struct<before: string, after: string>>")
    top = root.select("tree", F.lit(0).cast("long").alias("block"), none.alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    above = _descended(layers, top, scratch)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block, upper = Block(row["block"], row["digest"]), _upper(row)
            n = len(row["digest"])
            paths = [[{"before": a, "after": b} for a, b in [*block.path(i), *upper]] for i in range(n)]
            arrays = [row["source"], [0] * n, paths, row["digest"], [row["root"]] * n]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(arrays, [pa.string(), pa.int64(), *_PATH_ARROW], strict=True)],
                ["tree", "block", "path", "subroot", "root"],
            )

    return scratch.keep(blocks.join(above, ["tree", "block"]).mapInArrow(of, f"tree string, block long, {PATH}"), "subroots")


def _results(proofs: bool):
    """Rows of each block's documents: proof and version, from the block and its upper siblings."""
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.list_(pa.string())]
    names = ["leaf", "subroot", "root", "proof_sha256", "copied", "folded_root", "proof"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for i, row in enumerate(_rows(iter([batch.drop_columns(["doc_id"])]))):
                block, upper = Block(row["block"], row["digest"]), _upper(row)
                out: list[list] = [[] for _ in names]
                for at, (original, changed) in enumerate(zip(row["digest"], row["tampered"], strict=True)):
                    path = [*block.path(at), *upper]
                    proof = [a + b for a, b in path]
                    nodes = copied(changed or original, path)
                    values = (original, row["subroot"], row["root"], digest("".join(proof)), nodes if changed else None, (nodes or [changed or original])[-1], proof if proofs else None)
                    for held, value in zip(out, values, strict=True):
                        held.append(value)
                yield pa.RecordBatch.from_arrays(
                    [ids[i].values, *[pa.array(x, t) for x, t in zip(out, kinds, strict=True)]], ["doc_id", *names]
                )

    return of


def manifest(docs: DataFrame, tampered: Column | None = None, proofs: bool = False) -> DataFrame:
    """For each document its place in the Merkle tree of the dataset, and the root of the version in which it is tampered.

    ``docs`` has the columns of ``LEAF``. A leaf is the SHA-256 of these (``leaf``). The leaves of a source ascend by doc_id; every
    three consecutive nodes of a level (fewer at its end, even one) have the SHA-256 of their concatenated digests as parent, until one node is
    left, the ``subroot`` (of a lone leaf the leaf itself). The subroots, by source with null first, form a tree in the same way; its last node is
    ``root``. ``proof`` (with ``proofs``) holds the siblings of the leaf and its ancestors, one text for each level up to the root;
    ``proof_sha256`` is the digest of all of it. ``tampered`` gives another text for some documents and null for all others: ``copied`` are the nodes of
    that document's version, ``folded_root`` is its root, computed from the tampered leaf and the proof, and ``verified`` tells whether that is the
    root. Documents that are not tampered are folded from their own leaf, and tampering that changes nothing is verified.

    Nulls have their own sign in a leaf, so a null differs from an empty text. Null ids come first; rows of one id follow their
    digests, and equal rows are leaves of their own, in any order, as each has the same leaf. An empty table gives an empty one. Other columns are not
    read, the ids of LEAF alone are returned. A source of any size, and any number of sources, are spread over tasks: a task holds one block.
    """
    columns = {c: docs[c] for c in LEAF}
    changed = F.lit(None).cast("string") if tampered is None else tampered
    slim = docs.select(
        F.coalesce(F.concat(F.lit("="), docs["source"].cast("string")), F.lit("-")).alias("tree"),
        docs["doc_id"],
        leaf(columns).alias("digest"),
        F.when(changed.isNotNull(), leaf({**columns, "text": changed})).alias("tampered"),
        F.monotonically_increasing_id().alias("tie"),
    )
    with Scratch(docs.sparkSession) as scratch:
        order = ranked(scratch.keep(slim, "leaves"), "tree", ["doc_id", "digest", "tie"], "at", scratch)
        blocks = scratch.keep(_gathered(order, ["doc_id", "tampered"]), "leaf-blocks")
        layers, subroots = _climbed(blocks, scratch)
        paths = _descended(layers, _over_sources(subroots, scratch), scratch)
        schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, copied array<string>, folded_root string, proof array<string>"
        found = blocks.join(paths, ["tree", "block"]).mapInArrow(_results(proofs), schema)
        found = found.withColumn("verified", F.col("folded_root") == F.col("root"))
        return materialise(found if proofs else found.drop("proof"), "manifest")
