"""Connected components of an edge table by alternating large and small stars (Kiveris et al. 2014).

Edges and labels stay in DataFrames; every round is written to the shared folder. The smallest
neighbour of a node is pre-aggregated before the shuffle, so a hub's edges never meet in one group.
Before each round, every partition of about PART edges is contracted to stars by union-find, which shortens
paths without a shuffle; a graph of one partition is done with that.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base

PART = 200_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in edges (a, b: long): the smallest node it is connected with. Nulls and loops don't count."""
    now = base.cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state, before = _state(now), None
    while state != before:
        parts = max(1, -(-state[0] // PART))
        now = base.cut(_contract(now, parts))
        if parts == 1:
            break
        before = state
        now = base.cut(_small_star(_large_star(now)))
        state = _state(now)
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def _contract(edges: DataFrame, parts: int) -> DataFrame:
    """The same components: in each of so many partitions, every node joined to the smallest it is connected with there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.setdefault(top, top)) != top:
                top = up
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for batch in batches:
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        ends = [(x, top) for x in list(parent) if (top := root(x)) != x]
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*ends, strict=True)], ["a", "b"])

    return base.map_batches(edges.coalesce(parts), run, "a long, b long")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Joins each node's larger neighbours to the smallest of its neighbours and itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Joins each node and its smaller neighbours to the smallest of them. edges: a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
