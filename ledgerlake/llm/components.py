"""Connected components by alternating large and small stars, written after every round."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import stage


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's edges as stars around the smallest node of each local component."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (above := parent.get(top, top)) != top:
            top = above
        while (above := parent.get(x, x)) != top:
            parent[x], x = top, above
        return top

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 1_000_000:  # bounded memory: send what is known, begin anew
            yield _stars(parent, root)
            parent.clear()
    yield _stars(parent, root)


def _stars(parent: dict[int, int], root) -> pa.RecordBatch:
    nodes = list(parent)
    tops = [root(x) for x in nodes]
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(tops, pa.int64())], ["u", "v"])


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v), root the smallest node it reaches.

    Rounds grow with the logarithm of the number of nodes. Each round is a written table;
    a centre with very many neighbours is split by the adaptive skew join.
    """
    # Twice: what many small tasks have left is read back by few.
    for _ in range(2):
        edges = stage(edges.mapInArrow(_contracted, "u long, v long").filter("u != v"), f"{label}-edges")
    done = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == done or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        done = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), f"{label}-edges")
