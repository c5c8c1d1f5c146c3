"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import staged


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Point each node's larger (or smaller) neighbours at the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if larger else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = near.join(low, "u")
    if larger:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def connected_components(spark: SparkSession, edges: DataFrame, rows: int | None = None) -> DataFrame:
    """``node, root`` for every node of ``edges (u long, v long)``; the root is the component's smallest node.

    Each round is written to the shared folder, so the plan stays flat and a lost
    executor costs one round at most.  ``rows`` bounds the number of edges, if it is known.
    """
    def mark(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    current = staged(spark, edges.select("u", "v").filter("u <> v").distinct(), "components", rows)
    before = mark(current)
    while before[0]:
        current = staged(spark, _star(_star(current, True), False), "components", 2 * before[0])
        now = mark(current)
        if now == before:
            break
        before = now
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))


__all__ = ["connected_components"]
