"""Connected components by alternating star steps, on edges that stay in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import checkpointed


def _least(edges: DataFrame, of: str, among: str) -> DataFrame:
    """Every edge with the least of its node and that node's neighbours. The least is found by a partial
    aggregate, so a node with very many edges costs no single task."""
    least = edges.groupBy(of).agg(F.min(among).alias("m"))
    return edges.join(least, of).withColumn("m", F.least("m", of))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) from edges ``a`` and ``b``; nodes without an edge are not listed.

    Large-star links a node's larger neighbours to its least one, small-star its smaller ones; both keep
    what is connected, and in a number of rounds that grows with the logarithm of the nodes every node
    hangs on its least one. Each round is a checkpoint. Null ends and loops are passed over.
    """
    now = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _least(both, "a", "b").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = _least(large, "a", "b")
        now = checkpointed(
            small.select("a", F.col("m").alias("b"))
            .union(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
