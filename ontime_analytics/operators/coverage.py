"""Set comparisons: what one side has and the other lacks.

Both sides are reduced to distinct keys first, by aggregates that combine
map-side, so every join is between single rows of a key and none is skewed.
Keys are compared null-safe: a missing carrier is a carrier of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics.functions.parse import tail_key

BOTH, LEFT_ONLY, RIGHT_ONLY = "flown and registered", "flown only", "registered only"


def _flown(flights: DataFrame) -> DataFrame:
    return flights.filter(F.col("tail_num") != "NA").select(tail_key("tail_num").alias("tail"))


def unregistered_tails(flights: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Known tail numbers that the registry lacks, with their flights (left anti join)."""
    counts = _flown(flights).groupBy("tail").agg(F.count(F.lit(1)).alias("flights"))
    known = aircraft.select(F.col("tail").alias("registered")).distinct()
    return counts.join(known, counts["tail"].eqNullSafe(known["registered"]), "left_anti")


def tail_sets(flights: DataFrame, aircraft: DataFrame) -> DataFrame:
    """How many tail numbers are flown and registered, flown only, registered only (INTERSECT and EXCEPT)."""
    flown, known = _flown(flights).distinct(), aircraft.select("tail").distinct()
    parts = ((BOTH, flown.intersect(known)), (LEFT_ONLY, flown.subtract(known)), (RIGHT_ONLY, known.subtract(flown)))
    out = None
    for name, part in parts:
        rows = part.select(F.lit(name).alias("status"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("tails"))


def route_changes(flights: DataFrame) -> DataFrame:
    """Per month how many (carrier, origin) pairs are new against the month before, gone since, and kept.

    A full outer join of a month's pairs with the month before's; the first
    month and the one after the last have nothing to compare with and are left out."""
    pairs = flights.filter("month between 1 and 12 and year is not null").select(
        (F.col("year") * 12 + F.col("month") - 1).alias("at"), "carrier", "origin").distinct()
    before = pairs.select((F.col("at") + 1).alias("then"), F.col("carrier").alias("c"), F.col("origin").alias("o"))
    joined = pairs.join(before, (pairs["at"] == before["then"]) & pairs["carrier"].eqNullSafe(before["c"]) & pairs["origin"].eqNullSafe(before["o"]), "full_outer")
    counts = joined.groupBy(F.coalesce("at", "then").alias("month_no")).agg(
        F.count_if(F.col("then").isNull()).alias("gained"), F.count_if(F.col("at").isNull()).alias("lost"),
        F.count_if(F.col("at").isNotNull() & F.col("then").isNotNull()).alias("kept"))
    # a month that has pairs, after one that has
    return counts.filter("gained + kept > 0 and lost + kept > 0").select(
        F.floor(F.col("month_no") / 12).cast("int").alias("year"), (F.pmod("month_no", F.lit(12)) + 1).cast("int").alias("month"), "gained", "lost", "kept")
