"""Delay counts by calendar keys (Q1-Q5, and the share per year).

Each is one scan and one hash aggregate on a low-cardinality key: the
partial aggregate runs map-side, so only (key, partial) rows are shuffled,
whatever the skew of the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics.functions.parse import has_delay, month_name, net_delay_positive, percent, weekday_name


def delay_by_year(flights: DataFrame) -> DataFrame:
    """Q1: per year, minutes of departure delay of delayed flights, and all flights.

    Both measures come from the same aggregate (no self-join of two aggregates)."""
    minutes = F.when(has_delay(), F.col("dep_delay")).otherwise(F.lit(0))
    return flights.groupBy("year").agg(
        F.sum(minutes).cast("long").alias("delay_minutes"),
        F.count(F.lit(1)).alias("flights"),
    )


def delay_percent_by_year(flights: DataFrame) -> DataFrame:
    """Per year the share of the flights with a parsable departure delay that were delayed."""
    return flights.filter(F.col("dep_delay").isNotNull()).groupBy("year").agg(
        F.count(F.lit(1)).alias("flights"), F.count_if(has_delay()).alias("delayed_flights")) \
        .withColumn("delay_percent", percent("delayed_flights", "flights"))


def _delayed_count_by(flights: DataFrame, key: str) -> DataFrame:
    return flights.groupBy(key).agg(F.count_if(has_delay()).alias("delayed_flights"))


def _named(counts: DataFrame, label, name: str) -> DataFrame:
    """Counts per number -> counts per name: the few grouped rows are labelled,
    and all numbers without a name become one NULL group."""
    return counts.groupBy(label.alias(name)).agg(F.sum("delayed_flights").cast("long").alias("delayed_flights"))


def delays_by_day_of_week(flights: DataFrame) -> DataFrame:
    """Q2: delayed flights per weekday name (groups with none are kept)."""
    return _named(_delayed_count_by(flights, "day_of_week"), weekday_name("day_of_week"), "day_name")


def delays_by_day_of_month(flights: DataFrame) -> DataFrame:
    """Q3: delayed flights per day of month."""
    return _delayed_count_by(flights, "day_of_month")


def delays_by_month(flights: DataFrame) -> DataFrame:
    """Q4: delayed flights per month name, across all years."""
    return _named(_delayed_count_by(flights, "month"), month_name("month"), "month_name")


def net_delay_by_day_of_week(flights: DataFrame) -> DataFrame:
    """Q5: flights whose arrival + departure delay is positive, per weekday number."""
    return (flights.filter(net_delay_positive())
            .groupBy("day_of_week").agg(F.count(F.lit(1)).alias("flights")))
