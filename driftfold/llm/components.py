"""Connected components of an edge table, by alternating large-star and small-star steps, all in Spark.

A graph of at most LOCAL edges, a constant, is left to one task: the steps' many small stages would take longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftfold.llm.common import column, materialize

#: Edges that one task may hold.
LOCAL = 500_000
#: A graph that has not settled after so many double steps is a fault, not a large graph: these halve its depth.
MOST_STEPS = 40


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("u > v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _distinct(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of them; edges point to the smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return _distinct(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).collect()[0]
    return row["n"], row["h"]


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All of a small graph: roots are hooked to smaller ones and paths cut short until nothing changes."""
    ends = [np.concatenate(x) for x in zip(*((column(b, "u").to_numpy(), column(b, "v").to_numpy()) for b in batches), strict=True)]
    if not ends:
        return
    nodes, place = np.unique(np.concatenate(ends), return_inverse=True)
    a, b = place[: len(ends[0])], place[len(ends[0]) :]
    root = np.arange(len(nodes))
    while (root[a] != root[b]).any():
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], names=["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of every node with an edge; edges (u, v), loops and repeats allowed."""
    edges = materialize(edges.select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")).where("u <> v"), "edges")
    if edges.count() <= LOCAL:
        return materialize(edges.coalesce(1).mapInArrow(_roots, "node long, root long"), "roots")
    now = materialize(_distinct(edges), "edges")
    mark = _mark(now)
    for _ in range(MOST_STEPS):
        now = materialize(_small_star(_large_star(now)), "edges")
        if mark == (mark := _mark(now)):
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct())
