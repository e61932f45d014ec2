"""Nearest neighbours by cosine: an exact scan, and cells of a k-means quantiser probed as partitions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.operators.ordering import top_k
from reelstat.session import bounded_batches


def _cosines(batch: pd.Series, queries: Sequence[np.ndarray]) -> np.ndarray:
    """A row for each query: its cosine to each vector of the batch, NaN for vectors of another length and zero vectors."""
    lengths = np.array([-1 if v is None else len(v) for v in batch], int)
    out = np.full((len(queries), len(batch)), np.nan)
    for length in {len(q) for q in queries}:
        rows = np.flatnonzero(lengths == length)
        if not len(rows):
            continue
        m = np.stack([np.asarray(batch.iloc[i], dtype="float64") for i in rows])
        norms = np.linalg.norm(m, axis=1)
        for own, q in zip(out, queries, strict=True):
            if len(q) == length:
                product = norms * float(np.linalg.norm(q))
                with np.errstate(divide="ignore", invalid="ignore"):
                    own[rows] = np.where(product > 0, m @ q / product, np.nan)
    return out


def cosine_to(vec: Column, query: Sequence[float]) -> Column:
    """Cosine similarity of a vector column to one query vector, a numpy product per Arrow batch.

    Vectors of another length and zero vectors give NULL.
    """
    q = np.asarray(query, dtype="float64")

    @F.pandas_udf("double")
    def similarity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(_cosines(batch, [q])[0])

    scored = similarity(vec)
    return F.when(~F.isnan(scored), scored)


def vector_search(
    index: DataFrame, query: Sequence[float], k: int, vec: str = "embedding", tie: Sequence[str] = ()
) -> DataFrame:
    """The ``k`` rows most similar to ``query``; each task keeps its own best ``k`` before they are merged."""
    bounded_batches(index.sparkSession)
    scored = index.withColumn("similarity", cosine_to(F.col(vec), query)).where(F.col("similarity").isNotNull())
    return top_k(scored.drop(vec), "similarity", k, tie=tie)


@dataclass(frozen=True)
class CellIndex:
    """An index written as one partition per cell, and the cell centres."""

    path: str
    centers: list[list[float]]
    vec: str


def build_cells(
    index: DataFrame, path: str, cells: int, vec: str = "embedding", seed: int = 42, max_iter: int = 20
) -> CellIndex:
    """Quantise all vectors into ``cells`` cosine k-means cells and write them partitioned by cell.

    The centres are fitted on the vectors of the commonest length that are not zero; the others, which no search of that length
    can find, lie in cell -1. Only the centres reach the driver. A crowded cell is split over several files by the rebalancing
    exchange.
    """
    values = F.col(vec).cast("array<double>")
    squares = F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x)
    lengths = index.where(squares > 0).groupBy(F.size(vec).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    usual = lengths.orderBy(F.col("rows").desc(), "n").first()
    fit = F.coalesce((squares > 0) & (F.size(vec) == (usual["n"] if usual else -1)), F.lit(False))
    features = index.where(fit).withColumn("_features", array_to_vector(values))
    if usual is None:
        return _write_cells(index.withColumn("cell", F.lit(-1)), path, [], vec)
    model = KMeans(k=cells, distanceMeasure="cosine", seed=seed, maxIter=max_iter, featuresCol="_features", predictionCol="cell").fit(
        features
    )
    assigned = model.transform(features).drop("_features").unionByName(index.where(~fit).withColumn("cell", F.lit(-1)))
    return _write_cells(assigned, path, [[float(x) for x in c] for c in model.clusterCenters()], vec)


def _write_cells(assigned: DataFrame, path: str, centers: list[list[float]], vec: str) -> CellIndex:
    assigned.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(path)
    return CellIndex(path, centers, vec)


def assign_cells(index: DataFrame, path: str, centers: Sequence[Sequence[float]], vec: str = "embedding") -> CellIndex:
    """Write vectors partitioned by the given centre of largest cosine (ties: the first); zero and odd vectors lie in cell -1.

    All centres are compared in one function, so a task keeps one Python worker, however many centres there are.
    """
    queries = [np.asarray(c, dtype="float64") for c in centers]

    @F.pandas_udf("int")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            scores = _cosines(batch, queries)
            none = np.isnan(scores)
            best = np.where(none, -np.inf, scores).argmax(axis=0)
            yield pd.Series(np.where(none.all(axis=0), -1, best).astype(np.int32))

    bounded_batches(index.sparkSession)
    return _write_cells(index.withColumn("cell", nearest(vec)), path, [list(map(float, c)) for c in centers], vec)


def probe_cells(
    index: DataFrame, cells: CellIndex, query: Sequence[float], k: int, probes: int | None = None, tie: Sequence[str] = ()
) -> DataFrame:
    """The ``k`` most similar rows of the ``probes`` cells whose centres are closest to the query (read by partition pruning).

    ``index`` is the table read back from ``cells.path``. By default all cells are searched, which gives the exact answer; fewer
    give an approximate one, as rows of other cells are not looked at.
    """
    if probes is not None:
        centers, q = np.asarray(cells.centers), np.asarray(query, dtype="float64")
        similarity = centers @ q / (np.linalg.norm(centers, axis=1) * np.linalg.norm(q))
        index = index.where(F.col("cell").isin([int(i) for i in np.argsort(-similarity, kind="stable")[:probes]]))
    return vector_search(index.drop("cell"), query, k, cells.vec, tie)
