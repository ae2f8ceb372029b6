"""Per origin airport (Q6-Q14): delayed counts, mean delay, delay percent,
their thresholds and rankings.

All eleven results are views of one aggregate, :func:`airport_summary` (one
scan, one map-side-combined aggregate per origin).  Each query function below
plans ``view(summary(flights restricted to the rows the view can use))``; a
job producing several of them computes the summary once over all flights and
derives every result from it (``FROM_SUMMARY``), so the flights are scanned
once per job, not per result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics import schema as S
from ontime_analytics.functions.parse import (
    delayed_rows,
    exact_mean,
    has_delay,
    percent,
    truncated_mean,
)
from ontime_analytics.operators.ranking import at_least, at_most, bottom_k, top_k

KEY = ["origin"]


def airport_summary(flights: DataFrame) -> DataFrame:
    """Per origin: delayed flights, their delay minutes, and flights with a
    parsable delay (every delayed flight is one of them)."""
    delayed = has_delay()
    return flights.groupBy("origin").agg(
        F.count_if(delayed).alias("delayed_flights"),
        F.coalesce(F.sum(F.when(delayed, F.col("dep_delay"))), F.lit(0)).cast("long")
        .alias("delay_minutes"),
        F.count("dep_delay").alias("timed_flights"),
    )


# --- views of the summary -------------------------------------------------

def _counts(summary: DataFrame) -> DataFrame:
    """Delayed flights per origin; airports without any are absent."""
    return summary.filter(F.col("delayed_flights") > 0).select("origin", "delayed_flights")


def _averages(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("delayed_flights") > 0).select(
        "origin", truncated_mean("delay_minutes", "delayed_flights").alias("avg_delay_trunc"),
        exact_mean("delay_minutes", "delayed_flights").alias("avg_delay"))


def _percents(summary: DataFrame) -> DataFrame:
    """Delay percent among flights with a parsable delay."""
    return summary.filter(F.col("timed_flights") > 0).select(
        "origin", percent("delayed_flights", "timed_flights").alias("delay_percent"))


FROM_SUMMARY = {
    "airport_delay_count": lambda s: _counts(s).orderBy("delayed_flights", "origin"),
    "airport_delay_count_upper": lambda s, min_count=S.AIRPORT_COUNT_UPPER:
        at_least(_counts(s), "delayed_flights", min_count),
    "airport_delay_count_lower": lambda s, max_count=S.AIRPORT_COUNT_LOWER:
        at_most(_counts(s), "delayed_flights", max_count),
    "airport_average_delay": _averages,
    "airport_delay_percent": lambda s: _percents(s).orderBy("delay_percent", "origin"),
    "airport_delay_percent_upper": lambda s, min_pct=S.AIRPORT_PERCENT_UPPER:
        at_least(_percents(s), "delay_percent", min_pct),
    "airport_delay_percent_lower": lambda s, max_pct=S.AIRPORT_PERCENT_LOWER:
        at_most(_percents(s), "delay_percent", max_pct),
    "airport_count_top": lambda s, k=S.TOP_K: top_k(_counts(s), "delayed_flights", k, KEY),
    "airport_count_bottom": lambda s, k=S.TOP_K: bottom_k(_counts(s), "delayed_flights", k, KEY),
    "airport_percent_top": lambda s, k=S.TOP_K: top_k(_percents(s), "delay_percent", k, KEY),
    "airport_percent_bottom": lambda s, k=S.TOP_K: bottom_k(_percents(s), "delay_percent", k, KEY),
}


# Rows that cannot change a view are dropped before a single query aggregates:
# they add 0 to every measure the view reads, and a group made only of them
# is removed by the view's own filter - so the result is the same, with fewer
# rows aggregated (and the predicate pushed to the scan on the lake).
def _delayed_rows():
    return delayed_rows()


def _timed_rows():
    return F.col("dep_delay").isNotNull()


PREFILTERS = {
    "airport_delay_count": _delayed_rows, "airport_delay_count_upper": _delayed_rows,
    "airport_delay_count_lower": _delayed_rows, "airport_average_delay": _delayed_rows,
    "airport_count_top": _delayed_rows, "airport_count_bottom": _delayed_rows,
    "airport_delay_percent": _timed_rows, "airport_delay_percent_upper": _timed_rows,
    "airport_delay_percent_lower": _timed_rows, "airport_percent_top": _timed_rows,
    "airport_percent_bottom": _timed_rows,
}


def _view(name: str, flights: DataFrame, *params) -> DataFrame:
    return FROM_SUMMARY[name](airport_summary(flights.filter(PREFILTERS[name]())), *params)


# --- the queries ------------------------------------------------------------

def airport_delay_count(flights: DataFrame) -> DataFrame:
    """Q6: delayed flights per origin (airports without any are absent), as
    the full listing in ascending order of count (O3), ties by airport."""
    return _view("airport_delay_count", flights)


def airport_delay_count_upper(flights: DataFrame, min_count: int = S.AIRPORT_COUNT_UPPER) -> DataFrame:
    """Q7: Q6 rows with at least ``min_count`` delayed flights."""
    return _view("airport_delay_count_upper", flights, min_count)


def airport_delay_count_lower(flights: DataFrame, max_count: int = S.AIRPORT_COUNT_LOWER) -> DataFrame:
    """Q8: Q6 rows with at most ``max_count`` delayed flights."""
    return _view("airport_delay_count_lower", flights, max_count)


def airport_average_delay(flights: DataFrame) -> DataFrame:
    """Q9: mean departure delay of delayed flights per origin, truncated
    (integer division, as published) and exact."""
    return _view("airport_average_delay", flights)


def airport_delay_percent(flights: DataFrame) -> DataFrame:
    """Q10: percent of flights with a parsable delay that are delayed, per
    origin, in ascending order of percent (O4), ties by airport."""
    return _view("airport_delay_percent", flights)


def airport_delay_percent_upper(flights: DataFrame, min_pct: float = S.AIRPORT_PERCENT_UPPER) -> DataFrame:
    """Q11: Q10 rows at or above ``min_pct``."""
    return _view("airport_delay_percent_upper", flights, min_pct)


def airport_delay_percent_lower(flights: DataFrame, max_pct: float = S.AIRPORT_PERCENT_LOWER) -> DataFrame:
    """Q12: Q10 rows at or below ``max_pct``."""
    return _view("airport_delay_percent_lower", flights, max_pct)


def airport_count_top(flights: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """Q13: the k airports with the most delayed flights."""
    return _view("airport_count_top", flights, k)


def airport_count_bottom(flights: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """Q13: the k airports with the fewest delayed flights."""
    return _view("airport_count_bottom", flights, k)


def airport_percent_top(flights: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """Q14: the k airports with the highest delay percent."""
    return _view("airport_percent_top", flights, k)


def airport_percent_bottom(flights: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """Q14: the k airports with the lowest delay percent."""
    return _view("airport_percent_bottom", flights, k)
