"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut, map_arrow, small

#: A node with so many neighbours (the centre of a large star) gets its least neighbour by
#: a broadcast, as its edges would all go to one task otherwise.
HOT_DEGREE = 1_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges as stars: (node, smallest node it is linked with), roots left out."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    nodes = np.array(sorted(parent), np.int64)
    return nodes, np.array([root(int(x)) for x in nodes], np.int64)


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of edges as stars, so that repeated and implied edges go before any shuffle."""
    for batch in batches:
        nodes, roots = forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["u", "v"])


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v") % (1 << 31)), F.lit(0))).first())


def _with_least(rows: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """``rows`` (u, v) with m, the least neighbour of u in ``edges`` (u, v)."""
    least = cut(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), name)
    hot, rest = least.filter(F.col("n") >= HOT_DEGREE).select("u", "m"), least.filter(F.col("n") < HOT_DEGREE).select("u", "m")
    if hot.isEmpty():
        return rows.join(rest, "u")
    hot = small(hot)
    return rows.join(hot, "u").unionByName(rows.join(hot, "u", "left_anti").join(rest, "u"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): the smallest node it is connected with.

    Each round makes every node point to the smallest node of its neighbourhood; the
    number of rounds grows with the logarithm of the longest path. Rounds are written
    to the shared folder. Nodes without an edge to another node don't appear.
    """
    edges = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u is not null and v is not null and u <> v")
    edges = cut(map_arrow(edges, _contracted, "u long, v long").distinct(), "edges")
    mark = None
    while mark != (now := _mark(edges)):  # v < u in every edge
        mark = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both.filter("v > u"), both, "least").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = cut(large, "large")
        moved = _with_least(large, large, "least-large")
        edges = moved.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(moved.select("u", F.col("m").alias("v")))
        edges = cut(edges.distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
