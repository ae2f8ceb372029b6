"""Delays on daylight-saving crossover days, per year (Q15, Q16).

Both are views of :func:`dst_summary` (crossover-day flights, one aggregate
per year), so a job producing both scans the flights once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics import schema as S
from ontime_analytics.functions.calendar import dst_year_range, filter_dst_days
from ontime_analytics.functions.parse import (
    delayed_rows,
    exact_mean,
    has_delay,
    percent,
    truncated_mean,
)


def dst_summary(flights: DataFrame, first_year: int | None = S.DST_FIRST_YEAR,
                last_year: int | None = None) -> DataFrame:
    """Per year, on crossover days: delayed flights, their minutes, and
    flights with a parsable delay."""
    delayed = has_delay()
    used = flights.select("year", "month", "day_of_month", "dep_delay")
    return filter_dst_days(used, first_year, last_year).groupBy("year").agg(
        F.count_if(delayed).alias("delayed_flights"),
        F.coalesce(F.sum(F.when(delayed, F.col("dep_delay"))), F.lit(0)).cast("long")
        .alias("delay_minutes"),
        F.count("dep_delay").alias("timed_flights"),
    )


def every_year(flights: DataFrame) -> DataFrame:
    """The summary that jobs store: no year is left out, so that its views can take any range."""
    return dst_summary(flights, None, None)


def average_view(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("delayed_flights") > 0).select(
        "year", truncated_mean("delay_minutes", "delayed_flights").alias("avg_delay_trunc"),
        exact_mean("delay_minutes", "delayed_flights").alias("avg_delay"))


def percent_view(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("timed_flights") > 0).select(
        "year", percent("delayed_flights", "timed_flights").alias("delay_percent"))


def of_years(view):
    """``view`` of the years of a summary that a query's range names."""
    def run(summary: DataFrame, first_year: int | None = S.DST_FIRST_YEAR, last_year: int | None = None) -> DataFrame:
        return view(summary.filter(dst_year_range("year", first_year, last_year)))
    return run


FROM_SUMMARY = {"dst_average_delay": of_years(average_view), "dst_delay_percent": of_years(percent_view)}


def dst_average_delay(flights: DataFrame, first_year: int | None = S.DST_FIRST_YEAR,
                      last_year: int | None = None) -> DataFrame:
    """Q15: mean delay of delayed flights on crossover days, per year."""
    # only delayed rows can change this view (see airports.PREFILTERS)
    return average_view(dst_summary(flights.filter(delayed_rows()), first_year, last_year))


def dst_delay_percent(flights: DataFrame, first_year: int | None = S.DST_FIRST_YEAR,
                      last_year: int | None = None) -> DataFrame:
    """Q16: percent of crossover-day flights (parsable delay) that are delayed, per year."""
    return percent_view(dst_summary(flights.filter(F.col("dep_delay").isNotNull()), first_year, last_year))
