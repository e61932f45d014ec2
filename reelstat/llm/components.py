"""Connected components of a graph of any size: alternating large-star and small-star rounds as joins and aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.storage import Scratch

EDGES = "a long, b long"
#: Edges that a task contracts at once.
TOGETHER = 1 << 20


def forest(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from the nodes to the first one of their component, for links between places ``a`` and ``b`` in ``nodes``."""
    label = np.arange(len(nodes))
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            break
        label = least
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A star for each component of a task's own edges: the same components, with fewer edges and shorter ways."""

    def stars(held):
        ends = np.concatenate([np.stack([x.column(i).to_numpy() for i in range(2)]) for x in held], axis=1)
        nodes, places = np.unique(ends, return_inverse=True)
        places = places.reshape(2, -1)
        a, b = forest(nodes, places[0], places[1])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= TOGETHER:
            yield stars(held)
            held, size = [], 0
    if size:
        yield stars(held)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b"))).where("a <> b")


def _is_star(edges: DataFrame) -> bool:
    """Whether every node has either one edge up, or edges from below only."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("up")).union(edges.select("b", F.lit(None).cast("long")))
    seen = ends.groupBy("node").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.bool_or(F.col("up").isNull()).alias("root"))
    return seen.where("low <> high or (low is not null and root)").limit(1).count() == 0


def components(edges: DataFrame, into: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge; the component is its smallest node. The table is kept in ``into``.

    Tasks contract their own edges first. Hubs are aggregated map-side, and the joins back are plain equi-joins, which the
    adaptive planner splits where a hub holds many edges. Every round is written to the shared folder; rounds grow with the
    logarithm of the longest way. Null ends and loops are ignored; an empty table gives an empty one.
    """
    given = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    with Scratch(edges.sparkSession) as scratch:
        # kept, so that no task holds the Python workers of two steps at once
        given = scratch.keep(given, "given")
        now = scratch.keep(given.mapInArrow(_contract, EDGES).distinct(), "edges")
        scratch.drop(keep=1)
        while not _is_star(now):
            now = scratch.keep(_small_star(_large_star(now)).mapInArrow(_contract, EDGES).distinct(), "star")
            scratch.drop(keep=1)
        star = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        return into.keep(star.union(star.select(F.col("component").alias("node"), "component").distinct()), "components")
