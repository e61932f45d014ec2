"""N-gram Jaccard join: a blocked sparse matrix product of the document by n-gram incidence.

Documents are rows, word n-grams are columns. The columns are cut into blocks by hash, as many as the size bound asks for: two
sets of Jaccard similarity t differ in at most ``|smaller| * (1 - t) / t`` grams, so a set that fills more blocks than that agrees
wholly with each partner in a block that is not empty. Empty blocks are never sent; the rare sets that fill too few blocks send
their smallest grams as well, enough for two of them to have one in common. Larger sets need fewer blocks, and send none of a single
gram, which unrelated texts often share: hashes spread the grams that differ at random, and the blocks are so many that linked sets agree in none
of two grams or more about as rarely as two 64-bit hashes collide. Rows that agree are candidates if their sizes and sketches allow
the similarity: agreement by chance in a gram grows with the square of the input, and would join all rows in the end. Candidates are gathered in
families, and within blocks of rows of a family the product accumulates overlap counts column block by column block, dropping
pairs whose sizes or counts so far cannot reach the bound. The result is exact but for collisions of 64-bit hashes and blocks as rare.

Scale: equal sets are one row of the matrix. Rows that agree in one block or many are held against each other once, by sketches of
some bytes; what many rows agree in is cut into blocks of rows, each two of which are compared by themselves. Large families are cut into row
blocks, each pair of row blocks is one unit of work, and a unit returns a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.blocks import buckets_of, grouped, packed, units
from reelstat.llm.components import components
from reelstat.llm.sketch import meetings, possible, sketch
from reelstat.llm.storage import Scratch, bitmap, in_bitmap, materialise, repartition_count
from reelstat.llm.text import Slice, mix, shingles, released, slices, words

COLUMNS_AT_ONCE = 4096
#: Aimed-at share of sets that fill too few blocks.
SPARSE = 1e-3
#: Blocks of two grams or more in which linked sets agree, expected at least where blocks of one are not sent: none with a chance
#: of exp(-45) at most, less than 2**-64.
AGREEING = 45


def _block_count(low: int, differ: int) -> int:
    """Column blocks for sets of ``low`` grams or more, so that few of them fill only ``differ`` blocks or fewer."""
    best = (math.inf, differ + 1)
    for n in range(differ + 1, 2 * differ + 2):
        empty, most = n * (1 - 1 / n) ** low, n - differ
        # Chernoff's bound on the chance of ``most`` empty blocks
        chance = 0.0 if empty == 0 else 1.0 if empty >= most else math.exp(most - empty + most * math.log(empty / most))
        best = min(best, (chance, n))
        if chance <= SPARSE:
            return n
    return best[1]


def _wide_block_count(common: int, differ: int) -> int | None:
    """The fewest column blocks for sets with ``common`` grams or more in common that differ in ``differ`` at most, so that in ``AGREEING``
    blocks, expected, there are two grams or more and none that differs; None if no number is enough.

    The grams fall into blocks independently, so a block's lack of others and its number of common ones are negatively associated
    over the blocks, and the chance that no block is such a one is at most exp(-expected number).
    """
    n = np.unique(np.geomspace(2, 2 * differ + 2, 1000).astype(np.int64))
    empty = 1 - 1 / n
    agreeing = empty**differ * _filled(common, n, 2)
    enough = np.flatnonzero(agreeing >= AGREEING)
    return int(n[enough[0]]) if len(enough) else None


def _filled(size: int, n: int | np.ndarray, least: int) -> float | np.ndarray:
    """Expected blocks of n that hold ``least`` (1 or 2) of ``size`` grams or more."""
    empty = 1 - 1 / n
    return n * (1 - empty**size - (least > 1) * size / n * empty ** (size - 1))


class SizeClasses:
    """Classes of set sizes: partners of a set lie in its own class or the next one. ``blocks[c]`` (number of column blocks, grams of a
    block at least, blocks below which the smallest grams are sent as well) serves all pairs whose smaller set is of class c."""

    def __init__(self, threshold: Fraction, most: int):
        self.threshold = threshold
        lows, blocks = [1], []
        while lows[-1] <= most:
            low = lows[-1]
            high = int(low / threshold)
            differ = int(high * (1 - threshold) / threshold)
            n = _block_count(low, differ)
            wide = _wide_block_count(math.ceil(2 * threshold * low / (1 + threshold)), differ)
            # the way that sends fewer
            blocks.append((n, 1, differ + 1) if wide is None or _filled(low, wide, 2) >= _filled(low, n, 1) else (wide, 2, wide // 4))
            lows.append(high + 1)
        self.lows, self.blocks = np.array(lows), blocks

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.lows, size, side="right")) - 1


def _agreements(grams: np.ndarray, classes: SizeClasses) -> list[np.ndarray]:
    """One hash for each column block that a sorted set fills, under its own class and the one below.

    Where blocks of one gram count, a pair is lost only if neither set fills more blocks than grams may differ; such sets add a prefix
    of their sorted grams, which two sets of this similarity share a gram of.
    """
    out, sparse = [], False
    own = classes.of(len(grams))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams ^ np.uint64(0x5BD1E995)), dtype=np.uint64)])
    for c in (own - 1, own):
        if c < 0:
            continue
        n, least, few = classes.blocks[c]
        cuts = np.searchsorted(grams, (np.arange(1, n, dtype=np.float64) * (2.0**64 / n)).astype(np.uint64))
        bounds = np.concatenate([[0], cuts, [len(grams)]])
        size = np.diff(bounds)
        tag = np.uint64((c * 1_000_003 + 17) * 0x9E3779B97F4A7C15 % (1 << 64))
        value = mix((total[bounds[1:]] - total[bounds[:-1]]) + mix(np.arange(n, dtype=np.uint64) + tag) + size.astype(np.uint64))
        out.append(value[size >= least])
        sparse |= len(out[-1]) < few
    if sparse:
        prefix = len(grams) - math.ceil(classes.threshold * len(grams)) + 1
        out.append(mix(grams[:prefix] ^ np.uint64(0x94D049BB133111EB)))
    return out


def _sets(part: Slice, k: int) -> Iterator[np.ndarray]:
    gram, offsets = shingles(words(part), k)
    for i in range(len(part)):
        own = np.sort(gram[offsets[i] : offsets[i + 1]])
        yield own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) > 1 else own


_FOUND = "kind int, doc_id long, n long, d1 long, d2 long, bucket int, hashes binary, nodes binary"


def _scan(k: int, threshold: Fraction, buckets: int):
    """Rows of kind 0: size, digest and, once a slice, sketch (as ``hashes``) of a document's set. Kind 1: agreements of a slice by
    bucket, one for each hash of each distinct set."""

    def run(batches):
        classes = SizeClasses(threshold, 1 << 10)
        for part in slices(batches):
            ids = part.columns["doc_id"].cast(pa.int64())
            n, d1, d2, hashes, owners, sketches = [], [], [], [], [], []
            seen: set[tuple[int, int]] = set()
            for i, grams in enumerate(_sets(part, k)):
                n.append(len(grams))
                a, b = _digest(grams)
                d1.append(a)
                d2.append(b)
                if len(grams) < 2 or (a, b) in seen:
                    sketches.append(None)
                    continue
                seen.add((a, b))
                sketches.append(sketch(grams))
                if len(grams) >= classes.lows[-1]:
                    classes = SizeClasses(threshold, 2 * len(grams))
                for h in _agreements(grams, classes):
                    hashes.append(h)
                    owners.append(np.full(len(h), i))
            count = len(n)
            digest = [_signed(x) for x in (d1, d2)]
            others = pa.nulls(count, pa.int32()), pa.array(sketches, pa.binary()), pa.nulls(count, pa.binary())
            yield _batch(np.zeros(count, np.int32), ids, pa.array(n, pa.int64()), *digest, *others)
            if not hashes:
                continue
            # the digest stands for the set until its representative is known
            h, node = np.concatenate(hashes), digest[0][np.concatenate(owners)]
            order = np.argsort(h)
            h, node = h[order], node[order]
            bounds = buckets_of(h, buckets)
            full = np.flatnonzero(np.diff(bounds))
            m = len(full)
            none = pa.nulls(m, pa.int64())
            sent = ((h, packed), (node, np.ndarray.tobytes))
            blobs = [pa.array([write(x[bounds[j] : bounds[j + 1]]) for j in full], pa.binary()) for x, write in sent]
            yield _batch(np.full(m, 1, np.int32), none, none, none, none, full.astype(np.int32), *blobs)

    return released(run)


def _batch(*columns):
    names = [x.split()[0] for x in _FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names)


def _digest(grams: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests of a set, which tell sets apart; 0 for the empty one."""
    if not len(grams):
        return 0, 0
    return int(np.sum(mix(grams), dtype=np.uint64)), int(np.sum(mix(grams + np.uint64(0xABCD)), dtype=np.uint64))


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _gather(k: int, held: np.ndarray):
    """Digest and grams of the documents whose id may be in the bitmap."""

    def run(batches):
        for batch in batches:
            keep = in_bitmap(held, batch.column(2).to_numpy())
            if not keep.any():
                continue
            for part in slices(iter([batch.filter(pa.array(keep))])):
                sets = list(_sets(part, k))
                digests = [pa.array(_signed(list(d))) for d in zip(*map(_digest, sets), strict=True)]
                grams = pa.array([g.tobytes() for g in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([part.columns["doc_id"].cast(pa.int64()), *digests, grams], ["doc_id", "d1", "d2", "grams"])

    return released(run)


def _links(nodes: np.ndarray, sets: list[np.ndarray], threshold: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """The product of some rows with themselves: a spanning forest of the pairs that reach the threshold."""
    size = np.array([len(s) for s in sets])
    up, down = threshold.numerator, threshold.denominator
    if 2 * (up + down) * int(size.max()) < 1 << 31:
        size = size.astype(np.int32)  # half the memory of the matrices below
    row = np.repeat(np.arange(len(sets)), size)
    gram = np.concatenate(sets)
    order = np.argsort(gram, kind="stable")
    gram, row = gram[order], row[order]
    new = np.concatenate([[True], gram[1:] != gram[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1
    single = np.bincount(row[~shared[column]], minlength=len(sets))
    keep = shared[column]
    row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
    left = size - single.astype(size.dtype)  # columns still to come
    total = size[:, None] + size[None, :]
    # I / (x + y - I) >= up / down  <=>  I * (up + down) >= up * (x + y)
    alive = np.minimum(left[:, None], left[None, :]) * (up + down) >= up * total
    np.fill_diagonal(alive, False)
    count = np.zeros((len(sets), len(sets)), np.float32)
    begin = 0
    while begin < len(column) and alive.any():
        end = int(np.searchsorted(column, column[begin] + COLUMNS_AT_ONCE))
        rows, local = np.unique(row[begin:end], return_inverse=True)
        dense = np.zeros((len(rows), int(column[end - 1] - column[begin]) + 1), np.float32)
        dense[local, column[begin:end] - column[begin]] = 1
        count[np.ix_(rows, rows)] += dense @ dense.T
        left = left - np.bincount(row[begin:end], minlength=len(sets)).astype(left.dtype)
        alive &= (count + np.minimum(left[:, None], left[None, :])) * (up + down) >= up * total
        begin = end
    label = np.arange(len(sets))
    while alive.any():
        least = np.minimum(label, np.where(alive, label[None, :], len(sets)).min(axis=1))
        least = least[least]
        if (least == label).all():
            break
        label = least
    linked = label != np.arange(len(sets))
    return nodes[linked], nodes[label[linked]]


def _multiply(threshold: Fraction):
    """Spanning forests of unit after unit of rows (sorted by unit)."""

    def run(batches):
        for rows in grouped(batches):
            a, b = _links(np.array([x for _, x, _ in rows]), [np.frombuffer(g, np.uint64) for _, _, g in rows], threshold)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return released(run)


def jaccard_classes(docs: DataFrame, k: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text; other columns are ignored).

    The set of a document holds the distinct k-word shingles of its whole text, A-Z lower-cased; with fewer words the
    whole sequence is its one shingle. Sets of similarity ``threshold`` or more are linked, and the component is the
    smallest doc_id reachable by links. Null, empty and wordless texts have an empty set and are linked with nothing;
    equal rows get equal results, a row with a null doc_id joins its class under the smallest id known there; an empty table
    gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        return _classes(docs, k, threshold, scratch)


def _classes(docs: DataFrame, k: int, threshold: Fraction, scratch: Scratch) -> DataFrame:
    buckets = repartition_count(docs)
    found = scratch.keep(docs.mapInArrow(_scan(k, threshold, buckets), _FOUND), "incidence")
    sized = scratch.keep(found.where("kind = 0").select("doc_id", "n", "d1", "d2"), "sizes")
    # equal sets are one node, named by the first half of the digest
    met = (
        found.where("kind = 1")
        .select("bucket", "hashes", "nodes")
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(released(meetings), "unit long, node long")
    )
    met = scratch.keep(met.distinct(), "met")
    sketches = found.where("hashes is not null and kind = 0").select(F.col("d1").alias("node"), "n", F.col("hashes").alias("sketch"))
    near = met.join(sketches.dropDuplicates(["node"]), "node").select("unit", "node", "n", "sketch")
    near = near.repartition(buckets, "unit").sortWithinPartitions("unit").mapInArrow(possible(threshold), "a long, b long")
    family = components(near, scratch).withColumnRenamed("component", "family")
    scratch.discard("met")
    scratch.discard("incidence")

    # one document of each set in a family lends its text; equal digests in full make equal sets
    lender = sized.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("doc_id"))
    lender = lender.join(family, F.col("d1") == F.col("node")).select("doc_id", "d1", "d2", "n", "node", "family")
    lender = scratch.keep(lender, "lender")
    held = bitmap(lender, "doc_id")
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(len(held) * 64)).alias("slot")
    sets = docs.select("doc_id", "text", slot).mapInArrow(_gather(k, held), "doc_id long, d1 long, d2 long, grams binary")
    # rows of one id may have different texts: the digests name the one that is lent
    named_set = ["doc_id", "d1", "d2"]
    members = scratch.keep(sets.dropDuplicates(named_set).join(lender, named_set).drop("d1", "d2"), "members")
    scratch.discard("lender")
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(1.001 * math.log(1 / threshold)))
    work = units(members, size_class, "grams", scratch).repartition(buckets, "unit").sortWithinPartitions("unit")
    verified = work.mapInArrow(_multiply(threshold), "a long, b long")
    component = components(verified, scratch).withColumnRenamed("component", "class")

    named = sized.join(component, F.col("d1") == F.col("node"), "left")
    key = F.when(F.col("n") > 0, F.coalesce("class", "d1"))
    named = scratch.keep(named.select("doc_id", "n", key.alias("class")), "named")
    least = named.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows"))
    least = least.where("rows > 1").drop("rows")
    result = named.join(least, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return materialise(result, "jaccard")
