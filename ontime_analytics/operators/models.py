"""Delays per aircraft model (Q18-Q22, Q31-Q33).

All of them are views of one aggregate, :func:`model_summary`: per model,
sums of per-flight measures computed by
:func:`ontime_analytics.operators.aircraft.aggregate_by_model` (size-checked
broadcast, or per-tail pre-aggregation plus a co-partitioned join).  A job
producing several results computes the summary once (``FROM_SUMMARY``).

Measures: all flights; delayed flights; flights with a parsable delay (F2);
delayed flights with a known tail number and their minutes (F3); and all /
delayed flights that matched the registry (the inner-join view, Q31).
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
from ontime_analytics.operators.aircraft import ModelJoin, aggregate_by_model
from ontime_analytics.operators.ranking import at_least, bottom_k, top_k

KEY = ["model"]


def model_summary(flights: DataFrame, aircraft: DataFrame, join: ModelJoin | None = None) -> DataFrame:
    """One row per model label (``Unavailable`` = no registry match)."""
    delayed = has_delay()
    known = F.coalesce(F.col("tail_num") != "NA", F.lit(False))  # tail number known
    return aggregate_by_model(flights, aircraft, {
        "flights": F.lit(1),
        "delayed_flights": delayed.cast("int"),
        "timed_flights": F.col("dep_delay").isNotNull().cast("int"),
        "known_delayed": (delayed & known).cast("int"),
        "known_delay_minutes": F.when(delayed & known, F.col("dep_delay")).otherwise(F.lit(0)),
    }, join, matched=("flights", "delayed_flights"))


# --- views of the summary -------------------------------------------------

def _counts(s: DataFrame) -> DataFrame:
    """F3 rows (delayed, known tail) per model, incl. ``Unavailable``."""
    return s.filter(F.col("known_delayed") > 0) \
        .select("model", F.col("known_delayed").alias("delayed_flights"))


def _averages(s: DataFrame) -> DataFrame:
    return s.filter(F.col("known_delayed") > 0).select(
        "model", truncated_mean("known_delay_minutes", "known_delayed").alias("avg_delay_trunc"),
        exact_mean("known_delay_minutes", "known_delayed").alias("avg_delay"))


def _percents(s: DataFrame) -> DataFrame:
    """F2 rows (parsable delay), ``NA`` tails included as ``Unavailable``."""
    return s.filter(F.col("timed_flights") > 0).select(
        "model", percent("delayed_flights", "timed_flights").alias("delay_percent"))


FROM_SUMMARY = {
    "model_delay_count": _counts,
    "model_delay_count_upper": lambda s, min_count=S.MODEL_COUNT_UPPER:
        at_least(_counts(s), "delayed_flights", min_count),
    "model_average_delay": _averages,
    "model_average_delay_upper": lambda s, min_avg=S.MODEL_AVERAGE_UPPER:
        at_least(_averages(s), "avg_delay_trunc", min_avg),
    "model_delay_percent": _percents,
    "model_delay_percent_upper": lambda s, min_pct=S.MODEL_PERCENT_UPPER:
        at_least(_percents(s), "delay_percent", min_pct),
    "flights_delays_by_model": lambda s: s.filter(F.col("matched_flights") > 0).select(
        "model", F.col("matched_flights").alias("flights"),
        F.col("matched_delayed_flights").alias("delayed_flights")),
    "delays_by_model_all": lambda s: s.select("model", "delayed_flights"),
    "model_count_top": lambda s, k=S.TOP_K: top_k(_counts(s), "delayed_flights", k, KEY),
    "model_count_bottom": lambda s, k=S.TOP_K: bottom_k(_counts(s), "delayed_flights", k, KEY),
    "model_average_top": lambda s, k=S.TOP_K: top_k(_averages(s), "avg_delay_trunc", k, KEY),
    "model_percent_top": lambda s, k=S.TOP_K: top_k(_percents(s), "delay_percent", k, KEY),
}


def _known_delayed_rows():
    # filter form (pushable): a NULL delay or tail drops the row, as false would
    return delayed_rows() & (F.col("tail_num") != "NA")


def _timed_rows():
    return F.col("dep_delay").isNotNull()


# Rows that cannot change a view are dropped before a single query joins and
# aggregates (they add 0 to every measure it reads; groups made only of them
# are removed by its filter).  The inner-join and all-flights views keep all.
PREFILTERS = {
    "model_delay_count": _known_delayed_rows, "model_delay_count_upper": _known_delayed_rows,
    "model_average_delay": _known_delayed_rows, "model_average_delay_upper": _known_delayed_rows,
    "model_count_top": _known_delayed_rows, "model_count_bottom": _known_delayed_rows,
    "model_average_top": _known_delayed_rows,
    "model_delay_percent": _timed_rows, "model_delay_percent_upper": _timed_rows,
    "model_percent_top": _timed_rows,
}


def _view(name: str, flights: DataFrame, aircraft: DataFrame, join: ModelJoin | None, *params):
    if name in PREFILTERS:
        flights = flights.filter(PREFILTERS[name]())
    return FROM_SUMMARY[name](model_summary(flights, aircraft, join), *params)


# --- the queries ------------------------------------------------------------

def model_delay_count(flights: DataFrame, aircraft: DataFrame,
                      join: ModelJoin | None = None) -> DataFrame:
    """Q18: delayed flights (known tail) per model, incl. ``Unavailable``."""
    return _view("model_delay_count", flights, aircraft, join)


def model_delay_count_upper(flights: DataFrame, aircraft: DataFrame,
                            min_count: int = S.MODEL_COUNT_UPPER,
                            join: ModelJoin | None = None) -> DataFrame:
    """Q19: Q18 rows with at least ``min_count`` delayed flights."""
    return _view("model_delay_count_upper", flights, aircraft, join, min_count)


def model_average_delay(flights: DataFrame, aircraft: DataFrame,
                        join: ModelJoin | None = None) -> DataFrame:
    """Q20: mean delay of delayed flights (known tail) per model, truncated and exact."""
    return _view("model_average_delay", flights, aircraft, join)


def model_average_delay_upper(flights: DataFrame, aircraft: DataFrame,
                              min_avg: float = S.MODEL_AVERAGE_UPPER,
                              join: ModelJoin | None = None) -> DataFrame:
    """Q21: Q20 rows whose truncated mean is at least ``min_avg``."""
    return _view("model_average_delay_upper", flights, aircraft, join, min_avg)


def model_delay_percent(flights: DataFrame, aircraft: DataFrame,
                        join: ModelJoin | None = None) -> DataFrame:
    """Q22: percent delayed among flights with a parsable delay, per model
    (``NA`` tails included, as ``Unavailable``)."""
    return _view("model_delay_percent", flights, aircraft, join)


def model_delay_percent_upper(flights: DataFrame, aircraft: DataFrame,
                              min_pct: float = S.MODEL_PERCENT_UPPER,
                              join: ModelJoin | None = None) -> DataFrame:
    """Q22: Q22 rows at or above ``min_pct``."""
    return _view("model_delay_percent_upper", flights, aircraft, join, min_pct)


def flights_delays_by_model(flights: DataFrame, aircraft: DataFrame,
                            join: ModelJoin | None = None) -> DataFrame:
    """Q31: all flights and delayed flights per model; flights without a
    registry match are dropped (inner)."""
    return _view("flights_delays_by_model", flights, aircraft, join)


def delays_by_model_all(flights: DataFrame, aircraft: DataFrame,
                        join: ModelJoin | None = None) -> DataFrame:
    """Q32: delayed flights per model over all flights (models with 0 and
    ``Unavailable`` kept)."""
    return _view("delays_by_model_all", flights, aircraft, join)


def model_count_top(flights: DataFrame, aircraft: DataFrame, k: int = S.TOP_K,
                    join: ModelJoin | None = None) -> DataFrame:
    """Q33: the k models with the most delayed flights."""
    return _view("model_count_top", flights, aircraft, join, k)


def model_count_bottom(flights: DataFrame, aircraft: DataFrame, k: int = S.TOP_K,
                       join: ModelJoin | None = None) -> DataFrame:
    """Q33: the k models with the fewest delayed flights."""
    return _view("model_count_bottom", flights, aircraft, join, k)


def model_average_top(flights: DataFrame, aircraft: DataFrame, k: int = S.TOP_K,
                      join: ModelJoin | None = None) -> DataFrame:
    """Q33: the k models with the highest truncated mean delay."""
    return _view("model_average_top", flights, aircraft, join, k)


def model_percent_top(flights: DataFrame, aircraft: DataFrame, k: int = S.TOP_K,
                      join: ModelJoin | None = None) -> DataFrame:
    """Q33: the k models with the highest delay percent."""
    return _view("model_percent_top", flights, aircraft, join, k)
