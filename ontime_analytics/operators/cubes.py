"""Subtotals: cube, rollup and chosen grouping sets, from one pre-aggregate.

The flights are aggregated once on all keys, which shuffles partial sums only;
Spark's Expand then copies those few rows, not the flights, for each grouping
set.  ``level`` is ``grouping_id``: a bit is set for each key that is summed
over, so a total differs from the group of a NULL key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics.functions.parse import has_delay, is_cancelled, percent

MEASURES = ("flights", "delayed_flights", "cancelled_flights", "delay_minutes")


def base_counts(flights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The additive measures per combination of ``keys``; may be stored and unioned with those of other loads."""
    return flights.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("flights"), F.count_if(has_delay()).alias("delayed_flights"), F.count_if(is_cancelled()).alias("cancelled_flights"),
        F.coalesce(F.sum(F.when(has_delay(), F.col("dep_delay"))), F.lit(0)).cast("long").alias("delay_minutes"))


def subtotals(counts: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """Sums of :func:`base_counts` rows over all subsets of ``keys`` (a cube), or over the given grouping sets.

    Without any row there is no group, not even the grand total."""
    groups = counts.cube(*keys) if sets is None else counts.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys])
    return groups.agg(F.grouping_id().cast("int").alias("level"), *[F.sum(m).cast("long").alias(m) for m in MEASURES]) \
        .filter("flights > 0").withColumn("delay_percent", percent("delayed_flights", "flights"))


def delay_cube(flights: DataFrame) -> DataFrame:
    """Flights and delays by carrier, origin and month, with the subtotals of every combination."""
    keys = ["carrier", "origin", "month"]
    return subtotals(base_counts(flights, keys), keys)


def calendar_rollup(flights: DataFrame) -> DataFrame:
    """Flights and delays by year, month and day, with month, year and grand totals."""
    keys = ["year", "month", "day_of_month"]
    return subtotals(base_counts(flights, keys), keys, [keys[:n] for n in range(len(keys), -1, -1)])


def carrier_sets(flights: DataFrame) -> DataFrame:
    """Flights and delays by (carrier, year), (carrier, weekday) and (year, weekday), and no other totals."""
    keys = ["carrier", "year", "day_of_week"]
    return subtotals(base_counts(flights, keys), keys, [["carrier", "year"], ["carrier", "day_of_week"], ["year", "day_of_week"]])
