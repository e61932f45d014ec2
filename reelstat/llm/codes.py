"""Vector code compression: every part of a vector becomes the number of its nearest codebook entry.

Components are integers, so a dimension of a slice of rows holds few distinct values. For each dimension these values form a
dictionary; the squared differences of every value to all entries are tabulated once, and the distances of all rows to all
entries are rows of these tables, gathered by dictionary code and added over the dimensions of a part. Nothing is multiplied per row.

The codebooks (``entries`` times the vector's width) are all that tasks are sent and the driver holds; a round returns sums and counts of
the same size, whatever the number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.storage import Scratch, materialise
from reelstat.operators.joins import join_group_stats

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Rows that share a dictionary, and rows whose distances are added up at once.
SLICE_ROWS, STEP_ROWS = 4096, 256


@dataclass
class Codebooks:
    """Entries as an array (part, entry, position) of integers; ``width`` is the vectors' length before padding."""

    entries: np.ndarray
    width: int

    def distances(self, cells: np.ndarray) -> Iterator[np.ndarray]:
        """For each part, the squared distances (row, entry) of the rows of ``cells`` to all entries."""
        parts, entries, size = self.entries.shape
        most = max(int(np.abs(cells).max(initial=0)) + int(np.abs(self.entries).max(initial=0)), 1)
        kind = np.int32 if most * most * max(size, 1) < 1 << 31 else np.int64
        for part in range(parts):
            total = np.zeros((len(cells), entries), kind)
            tables = []
            for at in range(size):
                values, codes = np.unique(cells[:, part * size + at], return_inverse=True)
                difference = values.astype(np.int64)[:, None] - self.entries[part, :, at][None, :]
                tables.append(((difference * difference).astype(kind), codes.reshape(-1)))
            gathered = np.empty((min(STEP_ROWS, len(cells)), entries), kind)
            for begin in range(0, len(cells), STEP_ROWS):
                rows = total[begin : begin + STEP_ROWS]
                for table, codes in tables:
                    rows += np.take(table, codes[begin : begin + STEP_ROWS], axis=0, out=gathered[: len(rows)], mode="clip")
            yield total

    def nearest(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, part): the nearest entry's number, ties to the lower one, and the squared distance to it."""
        found = [(d.argmin(axis=1), d.min(axis=1)) for d in self.distances(cells)]
        return np.stack([a for a, _ in found], axis=1), np.stack([b for _, b in found], axis=1).astype(np.int64)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The integer vectors that the codes (row, part) stand for."""
        parts = [self.entries[p, codes[:, p]] for p in range(self.entries.shape[0])]
        return np.concatenate(parts, axis=1)[:, : self.width] if parts else np.zeros((len(codes), 0), np.int64)

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _whole(vectors: pa.Array, longest: int) -> tuple[np.ndarray, list[bytes]]:
    """Which vectors are kept, and their components as little-endian 32-bit integers."""
    values = pc.cast(pc.list_flatten(vectors), pa.float64())
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    x = values.to_numpy(zero_copy_only=False)  # null components become NaN
    ends = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    kept = (bad[ends[1:]] == bad[ends[:-1]]) & ~vectors.is_null().to_numpy(zero_copy_only=False)
    most = isqrt((1 << 60) // max(longest, 1)) >> 1
    with np.errstate(invalid="ignore", over="ignore"):
        cells = np.clip(np.nan_to_num(np.floor(x * SCALE)), -min(most, 1 << 27), min(most, 1 << 27)).astype("<i4")
    return kept, [cells[a:b].tobytes() for a, b in zip(ends[:-1][kept], ends[1:][kept], strict=True)]


def _cells(rows: DataFrame, vector: str, scratch: Scratch) -> DataFrame:
    longest = rows.agg(F.max(F.size(vector))).first()[0] or 0

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(vector)
            kept, cells = _whole(batch.column(at), longest)
            others = [c.filter(pa.array(kept)) for i, c in enumerate(batch.columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*others, pa.array(cells, pa.binary())], [*names, "cells"])

    plain = rows.drop(vector).schema
    return scratch.keep(rows.mapInArrow(of, plain.add("cells", "binary")), "cells")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Cells as an array (row, width); shorter vectors are padded with zeros."""
    out = np.zeros((len(column), width), np.int64)
    for i, raw in enumerate(column.to_pylist()):
        found = np.frombuffer(raw, "<i4")
        out[i, : len(found)] = found
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(begin, SLICE_ROWS)


def _sums(cells: DataFrame, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Rows assigned to each (part, entry), and the sums of their parts."""
    parts, entries, size = books.entries.shape

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, size), np.int64)
        for piece in _slices(batches):
            x = _matrix(piece.column(0), parts * size)
            codes, _ = books.nearest(x)
            for p in range(parts):
                count[p] += np.bincount(codes[:, p], minlength=entries)
                for j in range(size):
                    # at most 2**12 rows of at most 2**27: exact in a double
                    total[p, :, j] += np.bincount(codes[:, p], x[:, p * size + j], entries).astype(np.int64)
        used = np.flatnonzero(count.reshape(-1))
        slot = (used[:, None] * (size + 1) + np.arange(size + 1)).reshape(-1)
        value = np.concatenate([count.reshape(-1, 1), total.reshape(-1, size)], axis=1)[used].reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(value)], ["slot", "value"])

    added = cells.select("cells").mapInArrow(of, "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value"))
    out = np.zeros((parts * entries, size + 1), np.int64)
    for batch in added.toArrow().to_batches():  # a codebook's size at most
        out.reshape(-1)[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out[:, 0].reshape(parts, entries), out[:, 1:].reshape(parts, entries, size)


def _fit(cells: DataFrame, id_column: str, parts: int, entries: int, rounds: int) -> Codebooks:
    width = (cells.agg(F.max(F.octet_length("cells"))).first()[0] or 0) // 4
    size = -(-width // parts)
    first = cells.orderBy(F.col(id_column).asc_nulls_last(), "cells").limit(entries).select("cells").toArrow()
    start = _matrix(first.column(0).combine_chunks(), parts * size).reshape(len(first), parts, size)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)), width)
    for _ in range(rounds if len(start) else 0):
        count, total = _sums(cells, books)
        mean = np.floor_divide(total, np.maximum(count, 1)[:, :, None])
        books = Codebooks(np.where(count[:, :, None] > 0, mean, books.entries), width)
    return books


def compressed(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """(id, label, code, error, label_error) of every kept vector, and the codebooks that decode the codes.

    Component x counts as floor(1024 x). A vector is cut into ``parts`` equal parts; ``code`` holds the number of the nearest entry of each
    part's codebook as two hex digits each (more for over 256 entries), ``error`` the squared distance to them and ``label_error`` its
    sum over the rows of the same label, null labels together (null where it does not fit in a long). Codebooks start as the vectors
    with the smallest ids and move to the floored means of their rows in each round; an entry without rows stays. Fewer kept rows than
    ``entries`` give as many entries as rows; no row gives no entry and an empty table.

    Dropped are vectors that are null or hold a null or a non-finite component. Vectors may differ in length: shorter ones are padded with
    zeros to the longest, rounded up to a multiple of ``parts``; empty ones count as zeros. A component of more than 2**17 (less for vectors of
    over 16 thousand components) counts as that bound, so that errors fit in a long. Null ids come last and may repeat, as others; of rows of
    one id the codebook takes the smaller stored cells (as bytes) first. Repeated rows are rows of their own. Other columns are
    not read.
    """
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    digits = max(2, len(f"{entries - 1:x}"))
    with Scratch(vectors.sparkSession) as scratch:
        cells = _cells(rows, "vector", scratch)
        books = _fit(cells, "vec_id", parts, entries, rounds)
        total = books.entries.shape[0] * books.entries.shape[2]

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in _slices(batches):
                codes, errors = books.nearest(_matrix(piece.column(2), total))
                text = ["".join(f"{c:0{digits}x}" for c in row) for row in codes.tolist()]
                arrays = [piece.column(0), piece.column(1), pa.array(text, pa.string()), pa.array(errors.sum(axis=1))]
                yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "code", "error"])

        schema = cells.drop("cells").schema.add("code", "string").add("error", "long")
        coded = scratch.keep(cells.mapInArrow(encode, schema), "coded")
        by_label = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
        result = join_group_stats(coded, by_label, ["label"])
        result = result.select(F.col("vec_id").alias(id_column), F.col("label").alias(label), "code", "error", "label_error")
        return materialise(result, "codes"), books
