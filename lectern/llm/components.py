"""Connected components as joins: edges are pulled to the smallest neighbour, from
above and from below in turn, until nothing moves (Kiveris et al., 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lectern.llm.tables import arrow_map, drop, written

_HELD_EDGES = 1 << 20


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a task, some at a time, as stars around the smallest node of what they connect."""

    def stars(parent: dict[int, int]) -> pa.RecordBatch:
        rows = [(x, find(parent, x)) for x in parent]
        columns = np.array(rows, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b"])

    def find(parent: dict[int, int], x: int) -> int:
        while (up := parent[x]) != x:
            parent[x] = parent[up]
            x = up
        return x

    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = find(parent, parent.setdefault(a, a)), find(parent, parent.setdefault(b, b))
            if x != y:
                parent[max(x, y)] = min(x, y)
        if len(parent) > _HELD_EDGES:
            yield stars(parent)
            parent = {}
    if parent:
        yield stars(parent)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a")
    moved = tied.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the same components, as stars of what each task connects. Its centre is tied to itself."""
    return arrow_map(edges.select("a", "b").filter("a <> b"), _forest, "a long, b long")


def rough_classes(edges: DataFrame) -> DataFrame:
    """(node, label): nodes of one label are connected, but nodes that are connected may still have
    several labels, where :func:`components` goes on until nothing moves."""
    labels = written(contracted(edges).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "stars")
    above = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
    return labels.join(above, "label").select("node", F.col("above").alias("label"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b), undirected: the smallest node
    of its component. Loops and repeated edges change nothing; no edges, no rows."""
    edges = written(contracted(edges).filter("a <> b").distinct(), "edges")
    before = _state(edges)
    while True:
        moved = written(_small_star(_large_star(edges)), "edges")
        drop(edges)
        edges = moved
        now = _state(edges)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
