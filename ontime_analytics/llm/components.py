"""Connected components of a graph given as an edge table (large-star / small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics.llm.common import drop, store


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step on distinct undirected edges held as (a > b)."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = both.join(least, "u")
    if larger:
        out = met.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def components(edges: DataFrame, made: list[str] | None = None) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``a`` and ``b``, longs): the component is its smallest node.

    Loops, repeated edges and either direction may occur; an empty table gives
    no rows.  Each round is written to the shared folder and the one before is
    deleted; only a count and a checksum of the edges reach the driver.  Rounds
    grow with the logarithm of the longest chain.  The path of the table that the
    result reads is added to ``made``, for the caller to delete.
    """
    spark = edges.sparkSession
    now, path = store(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
        large, lp = store(_stars(now, True), "large-star")
        after, ap = store(_stars(large, False), "small-star")
        drop(spark, lp)
        drop(spark, path)
        now, path = after, ap
    if made is not None:
        made.append(path)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
