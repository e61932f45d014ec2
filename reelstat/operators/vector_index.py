"""Nearest neighbours by cosine through cells that are searched as far as an angle bound asks for.

Vectors lie in cells, each with the angle from its centre to its farthest member. By the triangle inequality of angles no member is more
similar to a query than ``cos(max(0, angle to the centre - radius))``. A search looks first at the cells of the highest bounds, until
they hold k rows; then at every other cell whose bound reaches the k-th best similarity found so far. The result is exact, and cells
that cannot matter are not read. New vectors go to the cell of the nearest centre; centres are not fitted again, radii grow.

Radii and row counts come from the table's marker. Centres (``cells`` times the vectors' length, whatever the number of vectors) are
all that tasks are sent.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat.session import materialise
from reelstat.sources.snapshots import SnapshotTable

#: Vectors that centres are fitted on, at most about so many, chosen by a hash of their id.
FIT_ROWS = 100_000
#: Rows of a block, queries of a block, and rows of a cell that share a task.
BLOCK_ROWS, BLOCK_QUERIES, SHARE_ROWS = 1024, 256, 1 << 18
#: Angles are taken this much wider (radians), which covers all rounding.
MARGIN = 1e-6
#: Similarities are compared and returned with so many digits, so that equal vectors tie whatever the order of summation.
DIGITS = 12


def _unit(vectors: Sequence, width: int) -> np.ndarray:
    """Unit vectors as rows; zeros for vectors that are null, of another length, zero, or not finite."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        if v is not None and len(v) == width:
            out[i] = np.asarray(v, dtype="float64")
    with np.errstate(all="ignore"):
        norms = np.sqrt((out * out).sum(axis=1))
        good = np.isfinite(norms) & (norms > 0)
        out[good] /= norms[good, None]
    out[~good] = 0
    return out


class VectorIndex:
    """Rows with a vector, laid out by cell below ``path``; ``id_column`` identifies a row."""

    def __init__(self, spark: SparkSession, path: str, id_column: str, vec: str = "embedding"):
        self.spark, self.id, self.vec = spark, id_column, vec
        self.rows = SnapshotTable(spark, f"{path.rstrip('/')}/rows", by="cell", cluster=(id_column,), time="angle")
        self.centres_table = SnapshotTable(spark, f"{path.rstrip('/')}/centres")

    def build(self, df: DataFrame, cells: int, seed: int = 42, max_iter: int = 20, fit_rows: int = FIT_ROWS) -> None:
        """Fit the centres on a sample of vectors of the commonest length and write all rows by cell.

        Rows whose vector is null, zero, not finite or of another length lie in cell -1, which no search can find.
        """
        values = F.col(self.vec).cast("array<double>")
        squares = F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x)
        found = df.where((squares > 0) & (squares < float("inf")))
        usual = found.groupBy(F.size(self.vec).alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
        centres = np.zeros((0, 0))
        if usual is not None:
            share = max(1, usual["rows"] // fit_rows)
            sample = found.where((F.size(self.vec) == usual["n"]) & (F.pmod(F.xxhash64(F.col(self.id)), F.lit(share)) == 0))
            features = sample.select(array_to_vector(values).alias("features"))
            fitted = KMeans(k=cells, distanceMeasure="cosine", seed=seed, maxIter=max_iter).fit(features)
            centres = _unit(fitted.clusterCenters(), usual["n"])
        schema = "cell int, centre array<double>"
        self.centres_table.replace(self.spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], schema))
        self.rows.replace(self._placed(df, centres))

    def centres(self) -> np.ndarray:
        """Unit centres by cell; as many as the index was built with."""
        return np.array([r["centre"] for r in self.centres_table.read().orderBy("cell").collect()])

    def _placed(self, df: DataFrame, centres: np.ndarray) -> DataFrame:
        """Every row with the cell of the nearest centre (ties: the first) and the angle to it."""

        @F.pandas_udf("struct<cell:int,angle:double>")
        def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                cell, angle = np.full(len(batch), -1, "int32"), np.full(len(batch), np.nan)
                if len(centres):
                    unit = _unit(batch.tolist(), centres.shape[1])
                    good = unit.any(axis=1)
                    cosine = unit[good] @ centres.T
                    cell[good] = cosine.argmax(axis=1)
                    angle[good] = np.arccos(np.clip(cosine.max(axis=1), -1, 1))
                yield pd.DataFrame({"cell": cell, "angle": pd.Series(angle).where(cell >= 0, None)})

        placed = df.withColumn("_place", place(F.col(self.vec)))
        return placed.select(*df.columns, "_place.cell", "_place.angle")

    def add(self, df: DataFrame) -> None:
        """Append rows to the cells of their nearest centres; no file is written again. They must not be in the index yet."""
        self.rows.append(self._placed(df, self.centres()))

    def missing(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` that the index does not hold yet, by id; of the index the ids alone are read."""
        return df.join(self.rows.read().select(self.id), self.id, "left_anti")

    def cells(self) -> dict[int, tuple[float, int]]:
        """Radius and rows of each cell that can be searched."""
        out: dict[int, tuple[float, int]] = {}
        for path, (_, angle, rows) in self.rows.bounds().items():
            cell = int(path.split("cell=")[-1])
            if cell >= 0:
                radius, before = out.get(cell, (0.0, 0))
                out[cell] = (max(radius, float(angle) + MARGIN), before + rows)
        return out

    def search(self, queries: DataFrame, k: int, query_id: str, vec: str | None = None, probes: int | None = None) -> tuple[DataFrame, DataFrame]:
        """(query id, id, similarity, rank from 1) of the ``k`` rows most similar to each query, and (query id, cells read).

        Ties go to the smaller id. With ``probes`` only so many cells of the nearest centres are read, which is approximate. Queries whose vector is
        null, zero or of another length have no rows. Ids of queries must be unique and not null.
        """
        centres, known = self.centres(), self.cells()
        asked = queries.select(F.col(query_id).alias("query"), F.col(vec or self.vec).alias("vector"))
        plan = materialise(self._planned(asked, centres, known, k, probes), "cells")  # both rounds and the report read it
        with_first = plan.select("query", "vector", F.explode("first").alias("cell"))
        best = self._best(with_first, centres.shape[-1], known, k)
        read = plan.select("query", F.size("first").alias("cells_read"))
        if probes is None:
            best = materialise(best, "best")
            worst = best.groupBy("query").agg(F.min("similarity").alias("worst"), F.count("*").alias("found"))
            rest = plan.join(worst, "query", "left").select("query", "vector", F.explode("others").alias("other"), "worst", "found")
            # fewer than k rows so far: every cell may matter
            needed = (F.coalesce("found", F.lit(0)) < k) | (F.col("other.bound") >= F.col("worst"))
            more = materialise(rest.where(needed).select("query", "vector", "other.cell"), "others")
            both = best.select("query", "id", "similarity").unionByName(
                self._best(more, centres.shape[-1], known, k).select("query", "id", "similarity")
            )
            best = _top(both, k)
            counts = more.groupBy("query").agg(F.count("*").alias("more"))
            read = read.join(counts, "query", "left").select("query", (F.col("cells_read") + F.coalesce("more", F.lit(0))).alias("cells_read"))
        named = F.col("query").alias(query_id)
        return best.select(named, F.col("id").alias(self.id if self.id != query_id else f"found_{self.id}"), "similarity", "rank"), read.select(named, "cells_read")

    def _planned(self, asked: DataFrame, centres: np.ndarray, known: dict, k: int, probes: int | None) -> DataFrame:
        """For each query the cells to read first, and the others with their bounds."""
        numbers = np.array(sorted(known), int)
        radius = np.array([known[c][0] for c in numbers])
        held = np.array([known[c][1] for c in numbers])
        cell = T.StructType().add("cell", "integer").add("bound", "double")
        schema = T.StructType(list(asked.schema.fields)).add("first", T.ArrayType(T.IntegerType())).add("others", T.ArrayType(cell))

        def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                first, others = [], []
                unit = _unit(batch["vector"].tolist(), centres.shape[-1]) if len(numbers) else np.zeros((len(batch), 0))
                for q in unit:
                    if not q.any():
                        first.append([])
                        others.append([])
                        continue
                    cosine = centres[numbers] @ q
                    bound = np.cos(np.maximum(np.arccos(np.clip(cosine, -1, 1)) - radius, 0)) + MARGIN
                    order = np.argsort(-(cosine if probes is not None else bound), kind="stable")
                    n = probes if probes is not None else int(np.searchsorted(np.cumsum(held[order]), k)) + 1
                    first.append([int(c) for c in numbers[order[:n]]])
                    others.append([{"cell": int(numbers[i]), "bound": float(bound[i])} for i in order[n:]])
                yield batch.assign(first=first, others=others)

        return asked.mapInPandas(of, schema)

    def _best(self, pairs: DataFrame, width: int, known: dict, k: int) -> DataFrame:
        """The best rows (query, id, similarity, rank) of each query among the cells it is paired with.

        Blocks of rows meet blocks of queries of the same cell, a matrix product each; a crowded cell is dealt out to several tasks.
        """
        shares = [(c, -(-rows // SHARE_ROWS)) for c, (_, rows) in known.items()]
        spread = self.spark.createDataFrame(shares, "cell int, shares int")  # a row for each cell
        groups = F.greatest(F.lit(1), F.ceil(F.count("*").over(Window.partitionBy("cell")) / BLOCK_QUERIES))
        asked = pairs.withColumn("block", F.pmod(F.xxhash64("query"), groups)).groupBy("cell", "block").agg(
            F.collect_list(F.struct("query", "vector")).alias("asked")
        )
        asked = asked.join(F.broadcast(spread), "cell").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        id_type = self.rows.read().schema[self.id].dataType
        packed = T.StructType().add("cell", "integer").add("ids", T.ArrayType(id_type)).add("units", "binary")

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for cell, rows in batch.groupby("cell", sort=False):
                    for i in range(0, len(rows), BLOCK_ROWS):
                        block = rows.iloc[i : i + BLOCK_ROWS]
                        units = _unit(block["vector"].tolist(), width).tobytes()
                        yield pd.DataFrame({"cell": [cell], "ids": [block["id"].tolist()], "units": [units]})

        stored = self.rows.read().select("cell", F.col(self.id).alias("id"), F.col(self.vec).alias("vector")).where("cell >= 0")
        wanted = pairs.select("cell").distinct()
        blocks = stored.join(F.broadcast(wanted), "cell", "left_semi").mapInPandas(pack, packed)  # at most a row for each cell
        dealt = blocks.join(F.broadcast(spread), "cell").withColumn("share", F.pmod(F.xxhash64("ids"), F.col("shares")).cast("int"))
        units = dealt.join(asked.drop("shares", "block"), ["cell", "share"]).select("ids", "units", "asked")
        out = T.StructType().add("query", pairs.schema["query"].dataType).add("id", id_type).add("similarity", "double")

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for ids, raw, queries in zip(batch["ids"], batch["units"], batch["asked"], strict=True):
                    m = np.frombuffer(raw, "float64").reshape(len(ids), width)
                    names = [q["query"] for q in queries]
                    found = np.round(_unit([q["vector"] for q in queries], width) @ m.T, DIGITS)
                    order = np.lexsort((np.broadcast_to(np.argsort(np.argsort(np.array(ids, object), kind="stable")), found.shape), -found), axis=1)[:, :k]
                    at = np.repeat(np.arange(len(names)), order.shape[1])
                    yield pd.DataFrame({
                        "query": [names[i] for i in at],
                        "id": [ids[j] for j in order.reshape(-1)],
                        "similarity": found[at, order.reshape(-1)],
                    })

        return _top(units.mapInPandas(score, out), k)


def _top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query; tasks drop all others of theirs before the shuffle."""
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
