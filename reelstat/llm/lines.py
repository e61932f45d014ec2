"""Line dedup by a segment-partition edit join.

Two lines within edit distance t share one of t + 1 segments that the shorter one is cut into: t edits cannot touch all of
them. Each line is indexed by its segments, and probes the indexes of every admissible length with the substrings that
could be such a segment. Lines that meet are verified with a banded bit-parallel edit distance, for many pairs at once.

Scale: equal lines are one node, named by a 64-bit hash. Tasks send hashes, not texts, one entry for each distinct hash of a
slice; candidate families are cut into bounded units (``blocks``), and a unit returns a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.blocks import buckets_of, grouped, meeting, packed, stars, units
from reelstat.llm.components import components, forest
from reelstat.llm.storage import Scratch, bitmap, fresh, in_bitmap, materialise, repartition_count
from reelstat.llm.text import FORGET, Slice, mix, released, slices

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SPACES = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D], np.uint32)
CELLS = 1 << 22
#: Text of a slice: its code points, their hashes and sums take some fifty times as much memory in every task.
SLICE_BYTES = 1 << 20


def tolerance(length: int | np.ndarray) -> int | np.ndarray:
    """Edits allowed between two lines, by the code points of the shorter one: none below 48, one below 96, else two."""
    return (np.asarray(length) >= 48) * 1 + (np.asarray(length) >= 96) * 1


MOST = int(tolerance(1 << 30))


#: Values and blanks of the code points below 2**16; others are computed.
_VALUE = mix((np.arange(1 << 16, dtype=np.uint64) + np.uint64(1)) * np.uint64(_ODD))
_BLANK = np.zeros(1 << 16, bool)
_BLANK[_SPACES] = True
_powers = {b: np.ones(1, np.uint64) for b in (_ODD, pow(_ODD, -1, 1 << 64))}


def _power(base: int, n: int) -> np.ndarray:
    """The first n powers, kept from one slice to the next."""
    if len(_powers[base]) < n:
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return _powers[base][:n]


def _forget() -> None:
    for base in _powers:
        _powers[base] = np.ones(1, np.uint64)


FORGET.append(_forget)


class Lines:
    """The lines of a slice as code points: begin and end of each, its row and its number in the row (from 0)."""

    def __init__(self, part: Slice, least: int):
        self.code = np.frombuffer(part.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        n, rows = len(self.code), np.arange(len(part))
        if n == len(part.data):
            offsets = part.offsets
        else:
            offsets = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])[part.offsets]
        # a row of n line feeds has n + 1 lines
        feed = np.flatnonzero(self.code == 10)
        feed_row = np.searchsorted(offsets, feed, side="right") - 1
        place = np.sort(np.concatenate([rows * (n + 2) + offsets[:-1], feed_row * (n + 2) + feed + 1]))
        self.row, self.begin = place // (n + 2), place % (n + 2)
        first = np.searchsorted(self.row, rows)
        self.end = np.append(self.begin[1:] - 1, 0)
        self.end[np.append(first[1:] - 1, len(place) - 1)] = offsets[1:]
        self.number = np.arange(len(place)) - first[self.row]
        self.count = np.bincount(self.row, minlength=len(part))
        high = n and int(self.code.max()) >= 1 << 16
        low = np.minimum(self.code, 0xFFFF) if high else self.code
        value = _VALUE[low]
        if high:
            beyond = self.code >= 1 << 16
            value[beyond] = mix((self.code[beyond].astype(np.uint64) + np.uint64(1)) * np.uint64(_ODD))
        black = np.concatenate([[0], np.cumsum(~_BLANK[low], dtype=np.int32)])
        self.length = self.end - self.begin
        self.eligible = (self.length >= least) & (black[self.end] > black[self.begin])
        self.down = _power(pow(_ODD, -1, 1 << 64), n + 1)
        value *= _power(_ODD, n + 1)[:n]
        self.total = np.empty(n + 1, np.uint64)
        self.total[0] = 0
        np.cumsum(value, out=self.total[1:])

    def span(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.total[end] - self.total[begin]) * self.down[begin]

    def nodes(self) -> np.ndarray:
        return mix(self.span(self.begin, self.end) + self.length.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)


def _key(substring: np.ndarray, length: np.ndarray, segment: int) -> np.ndarray:
    return mix(substring + mix(length.astype(np.uint64) * np.uint64(64) + np.uint64(segment)))


def _entries(x: Lines, keep: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``keep``, keys): the segments of each line, and the substrings with which it probes shorter or equal lines."""
    begin, length = x.begin[keep], x.length[keep]
    for edits in range(1, MOST + 1):
        for shorter in range(edits + 1):
            # an indexed line of this length is cut into edits + 1 segments, the longer ones last
            target = length - shorter
            chosen = np.flatnonzero(tolerance(target) == edits)
            if not len(chosen):
                continue
            b, n, t = begin[chosen], length[chosen], target[chosen]
            short, long_ = t // (edits + 1), t % (edits + 1)
            for i in range(edits + 1):
                size = short + (i >= edits + 1 - long_)
                place = i * short + np.maximum(0, i - (edits + 1 - long_))
                if shorter == 0:
                    yield chosen, _key(x.span(b + place, b + place + size), t, i)
                low = max(-i, shorter - (edits - i))
                high = min(i, shorter + (edits - i))
                for shift in range(low, high + 1):
                    if shorter == 0 and shift == 0:
                        continue  # the segment itself
                    at = place + shift
                    fits = (at >= 0) & (at + size <= n)
                    s = b[fits] + at[fits]
                    yield chosen[fits], _key(x.span(s, s + size[fits]), t[fits], i)


_FOUND = "kind int, doc_id long, digest long, n_lines int, numbers array<int>, nodes array<long>, a long, b long, bucket int, hashes binary, ends binary"


def _found(kind: int, rows: int, **columns: pa.Array) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    fields = [x.split() for x in _FOUND.split(", ")]
    columns["kind"] = pa.array(np.full(rows, kind, np.int32))
    return pa.RecordBatch.from_arrays([columns.get(n, pa.nulls(rows, types[t])) for n, t in fields], [n for n, _ in fields])


def _scan(least: int, buckets: int):
    """Kind 0: a row's count of lines, and number and node of the eligible ones. Kind 1: distinct keys of a slice by bucket, with
    one node each. Kind 2: the slice's further nodes of the same key."""

    def run(batches):
        for part in slices(batches, most=SLICE_BYTES):
            x = Lines(part, least)
            nodes, good = x.nodes(), x.eligible
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(x.row[good], minlength=len(part)))]).astype(np.int32))
            yield _found(
                0,
                len(part),
                doc_id=part.columns["doc_id"].cast(pa.int64()),
                digest=part.columns["digest"],
                n_lines=pa.array(x.count.astype(np.int32)),
                numbers=pa.ListArray.from_arrays(offsets, pa.array(x.number[good].astype(np.int32))),
                nodes=pa.ListArray.from_arrays(offsets, pa.array(nodes[good])),
            )
            keep = np.flatnonzero(good & (tolerance(x.length) > 0))
            if not len(keep):
                continue
            keep = keep[np.unique(nodes[keep], return_index=True)[1]]
            found = list(_entries(x, keep))
            node = np.concatenate([nodes[keep[c]] for c, _ in found])
            h = np.concatenate([k for _, k in found])
            a, b, lead = stars(h, node)
            yield _found(2, len(a), a=pa.array(a), b=pa.array(b))
            h, node = h[lead], node[lead]
            bounds = buckets_of(h, buckets)
            full = np.flatnonzero(np.diff(bounds))
            sent = ((h, packed), (node, np.ndarray.tobytes))
            hashes, ends = (pa.array([write(v[bounds[j] : bounds[j + 1]]) for j in full], pa.binary()) for v, write in sent)
            yield _found(1, len(full), bucket=pa.array(full.astype(np.int32)), hashes=hashes, ends=ends)

    return released(run)


def _texts(least: int, held: np.ndarray):
    """The distinct lines of a slice whose node may be in the bitmap: (node, n, line)."""
    low = np.uint64(len(held) * 64 - 1)

    def run(batches):
        for part in slices(batches, most=SLICE_BYTES):
            x = Lines(part, least)
            nodes = x.nodes()
            keep = np.flatnonzero(x.eligible & in_bitmap(held, nodes.view(np.uint64) & low))
            keep = keep[np.unique(nodes[keep], return_index=True)[1]]
            if not len(keep):
                continue
            texts = [x.code[b:e].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass") for b, e in zip(x.begin[keep], x.end[keep], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(x.length[keep].astype(np.int32)), pa.array(texts, pa.string())], ["node", "n", "line"])

    return released(run)


def edit_distances(pairs: list[tuple[np.ndarray, np.ndarray]], most: int) -> np.ndarray:
    """Edit distance of each pair of code point arrays, or ``most + 1`` where it is larger: banded bit-parallel columns.

    A column of the matrix is a word of vertical differences, of which only the 2 * most + 1 cells around the diagonal
    can matter. All pairs advance together, one code point of the second text at a time.
    """
    out = np.full(len(pairs), most + 1)
    pairs = [(a, b) if len(a) >= len(b) else (b, a) for a, b in pairs]  # the pattern is the longer
    n1, n2 = np.array([len(a) for a, _ in pairs]), np.array([len(b) for _, b in pairs])
    possible = np.flatnonzero(n1 - n2 <= most)
    possible = possible[np.argsort(n1[possible], kind="stable")]
    width = 2 * most + 1
    done = 0
    while done < len(possible):
        upto = done + 1
        while upto < len(possible) and (upto - done + 1) * n1[possible[upto]] <= CELLS:
            upto += 1
        own = possible[done:upto]
        done = upto
        # an equal beginning changes no distance, and the band's lower edge starts within the pattern
        m, n = n1[own] + most, n2[own] + most
        pattern = np.full((m.max() + 2 * most + 1, len(own)), 0xFFFFFFFF, np.uint32)
        text = np.full((n.max() + 1, len(own)), 0xFFFFFFFE, np.uint32)
        pattern[most : 2 * most] = text[:most] = 0xFFFFFFFD
        for k, p in enumerate(own):
            pattern[2 * most : most + m[k], k], text[most : n[k], k] = pairs[p]
        # bit d of a word stands for pattern place j + d - most when text place j is read; the highest bit is the band's lower edge
        one = np.uint64(1)
        full = np.uint64((1 << width) - 1)
        edge = np.uint64(width - 1)
        positive = np.full(len(own), np.uint64(((1 << (most + 1)) - 1) << most))
        negative = np.zeros(len(own), np.uint64)
        score = np.full(len(own), most)
        for j in range(int(n.max())):
            same = np.zeros(len(own), np.uint64)
            for d in range(width):
                same |= (pattern[j + d] == text[j]).astype(np.uint64) << np.uint64(d)
            zero = ((((same & positive) + positive) ^ positive) | same | negative) & full
            right = negative | (~(zero | positive) & full)
            left = zero & positive
            diagonal = j < m - most
            running = j < n
            score += np.where(running & diagonal, 1 - ((zero >> edge) & one).astype(np.int64), 0)
            # the lower edge has left the pattern: follow its last row, one bit lower with each column
            low = np.clip(width - 1 - 1 - (j - (m - most)), 0, 63).astype(np.uint64)
            step = ((right >> low) & one).astype(np.int64) - ((left >> low) & one).astype(np.int64)
            score += np.where(running & ~diagonal, step, 0)
            shifted = zero >> one
            positive = (left | ~(shifted | right)) & full
            negative = shifted & right
        out[own] = np.minimum(score, most + 1)
    return out


def _bags(texts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(texts), 64), np.int32)
    for i, t in enumerate(texts):
        out[i] = np.bincount(t % 64, minlength=64)
    return out


def _possible(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a unit not excluded by length or by counts of characters: t edits change at most 2t counts."""
    length = np.array([len(t) for t in texts])
    bag = _bags(texts)
    first, second = [], []
    for i in range(len(texts) - 1):
        t = tolerance(np.minimum(length[i], length[i + 1 :]))
        ok = np.abs(length[i + 1 :] - length[i]) <= t
        j = np.flatnonzero(ok)
        j = j[np.abs(bag[i + 1 :][j] - bag[i]).sum(axis=1) <= 2 * t[j]]
        first.append(np.full(len(j), i))
        second.append(j + i + 1)
    return np.concatenate(first or [[]]).astype(int), np.concatenate(second or [[]]).astype(int)


def _verified(batches):
    """Links of unit after unit (sorted by unit); the distances of many units are computed together."""

    def flush(held):
        pairs = [(texts[i], texts[j]) for _, texts, a, b in held for i, j in zip(a, b, strict=True)]
        far = edit_distances(pairs, MOST)
        at, first, second = 0, [], []
        for nodes, texts, a, b in held:
            length = np.array([len(t) for t in texts])
            near = far[at : at + len(a)] <= tolerance(np.minimum(length[a], length[b]))
            at += len(a)
            x, y = forest(nodes, a[near], b[near])
            first.append(x)
            second.append(y)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(first)), pa.array(np.concatenate(second))], ["a", "b"])

    held, cells = [], 0
    for rows in grouped(batches):
        nodes = np.array([r[1] for r in rows], np.int64)
        texts = [np.frombuffer(r[2].encode("utf-32-le", "surrogatepass"), np.uint32) for r in rows]
        a, b = _possible(texts)
        if not len(a):
            continue
        held.append((nodes, texts, a, b))
        cells += sum(len(texts[i]) for i in a)
        if cells >= CELLS:
            yield flush(held)
            held, cells = [], 0
    if held:
        yield flush(held)


def line_classes(docs: DataFrame, scratch: Scratch, least: int = 16) -> tuple[DataFrame, DataFrame]:
    """The lines of each document (doc_id, digest of the text, n_lines, numbers, nodes of the lines with ``least`` code points or more and
    a word), and (node, class) of the nodes that an edit link joins to others; both kept in ``scratch``."""
    buckets = repartition_count(docs)
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    found = scratch.keep(docs.mapInArrow(_scan(least, buckets), _FOUND), "lines")
    numbered = found.where("kind = 0").select("doc_id", "digest", "n_lines", "numbers", "nodes")
    met = found.where("kind = 1").select("bucket", "hashes", "ends").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    edges = met.mapInArrow(released(meeting), "a long, b long").union(found.where("kind = 2").select("a", "b"))
    family = components(edges, scratch).withColumnRenamed("component", "family")
    held = bitmap(family, "node", hashed=True)
    lines = docs.select("text").mapInArrow(_texts(least, held), "node long, n int, line string").dropDuplicates(["node"])
    members = scratch.keep(lines.join(family, "node"), "members")
    work = units(members, F.floor(F.col("n") / (MOST + 1)), "line", scratch).repartition(buckets, "unit").sortWithinPartitions("unit")
    links = work.mapInArrow(released(_verified), "a long, b long")
    return numbered, components(links, scratch).withColumnRenamed("component", "class")


def repeated_lines(docs: DataFrame, least: int = 16) -> DataFrame:
    """(doc_id, n_lines, removed) for each row of ``docs``: the numbers (from 0) of the lines that equal, up to a few edits,
    a line kept elsewhere.

    Lines end at line feeds. Lines of ``least`` code points or more with a word fall into classes, connected by edit
    distances within ``tolerance`` of the shorter one's length; of each class the first line by doc_id and number stays. Shorter
    lines always stay. Null and empty texts lose nothing. Equal rows have equal results, as an id, text and number name one line; rows of one
    id with different texts are documents of their own, in the order of a hash of the text; rows
    with a null doc_id lose nothing and take nothing from others. Other columns are ignored; an empty table gives an empty result.
    """
    with Scratch(docs.sparkSession) as scratch:
        return _repeated(docs, least, scratch).drop("digest")


def _repeated(docs: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """``repeated_lines`` with the digest of each row's text."""
    numbered, near = line_classes(docs, scratch, least)
    line = numbered.select("doc_id", "digest", F.explode(F.arrays_zip("numbers", "nodes")).alias("l"))
    line = line.select(F.struct("doc_id", "digest", "l.numbers").alias("line"), "l.nodes").where("line.doc_id is not null")
    of_node = line.groupBy("nodes").agg(F.min("line").alias("first"), F.count("*").alias("n"))
    classed = of_node.join(near, F.col("nodes") == F.col("node"), "left").select("nodes", "first", "n", F.coalesce("class", "nodes").alias("class"))
    kept = classed.groupBy("class").agg(F.min("first").alias("kept"), F.sum("n").alias("n")).where("n > 1")
    repeated = scratch.keep(classed.select("nodes", "class").join(kept, "class").select("nodes", "kept"), "repeated")
    again = line.join(repeated, "nodes").where("line <> kept")
    removed = again.groupBy("line.doc_id", "line.digest").agg(F.sort_array(F.collect_set("line.numbers")).alias("removed"))
    nothing = F.array().cast("array<int>")
    rows = numbered.select("doc_id", "digest", "n_lines").join(removed, ["doc_id", "digest"], "left")
    found = rows.select("doc_id", "digest", F.col("n_lines").cast("long").alias("n_lines"), F.coalesce("removed", nothing).alias("removed"))
    return materialise(found, "repeated_lines")


def without_repeated_lines(docs: DataFrame, least: int = 16) -> DataFrame:
    """``docs`` with the repeated lines cut from its texts; a document all of whose words were in them is dropped.

    Other columns stay as they are. See ``repeated_lines``. A text of any number of lines is cut in one walk over them.
    """
    with Scratch(docs.sparkSession) as scratch:
        lost = _repeated(docs, least, scratch).where(F.size("removed") > 0).distinct()
    taken = list(docs.columns)
    names = []
    for name in ("doc_id", "digest", "kept", "lines"):
        names.append(fresh(f"_{name}", [*taken, *names]))
    number, digest, kept, lines = names
    stay = F.array_except(F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), "removed")
    lost = lost.select(F.col("doc_id").alias(number), F.col("digest").alias(digest), stay.alias(kept))
    cut = docs.join(lost, (docs["doc_id"].cast("long") == lost[number]) & (F.xxhash64(docs["text"].cast("string")) == lost[digest]), "left")
    # behind a one-element explode the text is split once, not once for each line
    cut = cut.select("*", F.explode(F.array(F.when(F.col(kept).isNotNull(), F.split("text", "\n", -1)))).alias(lines))
    left = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    cut = cut.withColumn("text", F.when(F.col(kept).isNull(), F.col("text")).otherwise(left))
    return cut.where(F.col(kept).isNull() | F.col("text").rlike("[^ \t\n\x0b\f\r]")).select(*docs.columns)
