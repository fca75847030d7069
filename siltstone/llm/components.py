"""Connected components: within each task, then by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import materialize

#: Vertices that a task holds at a time when it connects its own edges.
VERTICES = 200_000


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the neighbours of each vertex to the least of them: those above it (large star),
    or it and those below it (small star). The least one is found by a combining aggregate, and
    the join back is one that Spark can split where a vertex has very many neighbours."""
    near = _both_ways(edges)
    if not large:
        near = near.filter("b < a")
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = near.join(least, "a")
    if large:
        out = moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return out.filter("a <> b").distinct()


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from each vertex of a task to the least of those it is connected with there. A task holds
    VERTICES at a time."""
    parent: dict[int, int] = {}

    def find(v: int) -> int:
        while (up := parent.setdefault(v, v)) != v:
            parent[v] = parent.setdefault(up, up)
            v = parent[v]
        return v

    def found() -> pa.RecordBatch:
        rows = [(v, root) for v in list(parent) if (root := find(v)) != v]
        return pa.RecordBatch.from_arrays(
            [pa.array([v for v, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.int64())], ["a", "b"]
        )

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            one, two = find(a), find(b)
            parent[max(one, two)] = min(one, two)
        if len(parent) > VERTICES:
            yield found()
            parent.clear()
    yield found()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every vertex has one edge down or only edges up."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    return ends.groupBy("v").agg(F.sum("down").alias("down"), F.max("up").alias("up")).filter(
        "down > 1 OR down + up > 1"
    ).isEmpty()


def components(edges: DataFrame, count: int | None = None) -> DataFrame:
    """vertex, root: the least vertex of its component, for every vertex of an edge (a, b).

    Tasks first connect what they hold, edges of about VERTICES vertices each; few edges need no further step.
    Every step is written to the shared folder; the loop ends when only stars are left. `count` is the
    number of edges, if it is known.
    """
    tasks = -(-2 * (edges.count() if count is None else count) // VERTICES)
    now = edges.select("a", "b").filter("a <> b").coalesce(max(1, tasks)).mapInArrow(_forest, "a long, b long")
    now = materialize(now, "forest")
    while tasks > 1 and not _is_stars(now):
        large = materialize(_star(now, True), "large-star")
        now = materialize(_star(large, False), "small-star")
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct()
    )
