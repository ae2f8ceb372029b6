"""Shared aggregates for multi-result jobs (calendar and cancellation families).

A job that produces several results over different keys aggregates the
flights once at a fine grain and rolls each result up from that small table
(stored under ``spark.checkpoint.dir`` by the job runner), so 100 TB of
flights are scanned once per family instead of once per result.

The single queries keep their direct plans (one aggregate on their own key),
which shuffle fewer partial rows when only one result is wanted; the tests
check that every view here equals its direct query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_analytics import schema as S
from ontime_analytics.functions.parse import (
    cancellation_reason,
    exact_mean,
    has_delay,
    is_cancelled,
    month_name,
    net_delay_positive,
    weekday_name,
)
from ontime_analytics.functions.calendar import filter_dst_days
from ontime_analytics.operators import dst
from ontime_analytics.operators.cancellations import _reason_rows


def _sum(c: str) -> Column:
    return F.sum(c).cast("long").alias(c)


# --- calendar: (year, month, day, weekday, carrier) ---------------------------

def calendar_summary(flights: DataFrame) -> DataFrame:
    """Per (year, month, day_of_month, day_of_week, carrier): flights, delayed
    flights and their minutes, flights with a parsable delay, flights with a
    positive net delay, cancelled flights."""
    delayed = has_delay()
    return flights.groupBy("year", "month", "day_of_month", "day_of_week", "carrier").agg(
        F.count(F.lit(1)).alias("flights"),
        F.count_if(delayed).alias("delayed_flights"),
        F.count("dep_delay").alias("timed_flights"),
        F.coalesce(F.sum(F.when(delayed, F.col("dep_delay"))), F.lit(0)).cast("long")
        .alias("delay_minutes"),
        F.count_if(F.coalesce(net_delay_positive(), F.lit(False))).alias("net_delayed"),
        F.count_if(is_cancelled()).alias("cancelled_flights"),
    )


def _delayed_by(s: DataFrame, key: Column, name: str) -> DataFrame:
    return s.groupBy(key.alias(name)).agg(_sum("delayed_flights"))


def _dst_years(view):
    """``view`` of the per-year crossover-day summary of :mod:`dst`, rolled up from dates."""
    def run(s: DataFrame, first_year: int | None = S.DST_FIRST_YEAR, last_year: int | None = None) -> DataFrame:
        return view(filter_dst_days(s, first_year, last_year).groupBy("year").agg(
            _sum("delayed_flights"), _sum("delay_minutes"), _sum("timed_flights")))
    return run


CALENDAR_VIEWS = {
    "delay_by_year": lambda s: s.groupBy("year").agg(_sum("delay_minutes"), _sum("flights")),
    "delays_by_day_of_week": lambda s: _delayed_by(s, weekday_name("day_of_week"), "day_name"),
    "delays_by_day_of_month": lambda s: _delayed_by(s, F.col("day_of_month"), "day_of_month"),
    "delays_by_month": lambda s: _delayed_by(s, month_name("month"), "month_name"),
    "net_delay_by_day_of_week": lambda s: s.groupBy("day_of_week")
        .agg(F.sum("net_delayed").cast("long").alias("flights")).filter(F.col("flights") > 0),
    "cancellations_by_carrier": lambda s: s.groupBy("carrier")
        .agg(_sum("flights"), _sum("cancelled_flights")),
    "monthly_airlines_delays": lambda s: s.groupBy("year", "month").agg(
        _sum("flights"), F.countDistinct("carrier").alias("airlines"), _sum("delayed_flights")),
    "dst_average_delay": _dst_years(dst.average_view),
    "dst_delay_percent": _dst_years(dst.percent_view),
}


# --- cancellations and delay reasons: (year, month, raw code, cancelled?) ------

def cancellation_summary(flights: DataFrame) -> DataFrame:
    """Per (year, month, raw cancellation code, cancelled?): flights, and for
    each delay reason the minutes, the parsable and the positive counts."""
    aggs = [F.count(F.lit(1)).alias("flights")]
    for _, c in S.DELAY_REASONS:
        aggs += [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"{c}_minutes"),
                 F.count(c).alias(f"{c}_timed"),
                 F.count_if(F.col(c) > 0).alias(f"{c}_positive")]
    return flights.groupBy("year", "month", "cancel_code_raw",
                           is_cancelled().alias("is_cancelled")).agg(*aggs)


def _reason(s: DataFrame) -> Column:
    # the raw code upper-cased is the typed code ('' has no reason either way)
    return cancellation_reason(F.upper(F.col("cancel_code_raw")))


def _by_reason(s: DataFrame) -> DataFrame:
    c = F.col("is_cancelled")
    reason = _reason(s)
    labels = [label for _, label in S.CANCELLATION_REASONS]
    n = F.col("flights")
    row = s.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("_all"),
        *[F.coalesce(F.sum(F.when(c & (reason == label), n)), F.lit(0)).alias(f"_r{i}")
          for i, label in enumerate(labels)],
        F.coalesce(F.sum(F.when(c & reason.isNull(), n)), F.lit(0)).alias("_unknown"),
    )
    return _reason_rows(row, "_all", [f"_r{i}" for i in range(len(labels))], "_unknown")


def _reasons_unpivot(s: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Global totals per delay reason, one row per reason label (none for
    empty input)."""
    row = s.agg(F.coalesce(F.sum("flights"), F.lit(0)).alias("_rows"),
                *[F.sum(f"{c}_{src}").cast("long").alias(f"{c}__{out}")
                  for _, c in S.DELAY_REASONS for out, src in fields.items()])
    structs = [F.struct(F.lit(label).alias("reason"),
                        *[F.coalesce(F.col(f"{c}__{out}"), F.lit(0).cast("long")).alias(out)
                          for out in fields])
               for label, c in S.DELAY_REASONS]
    return row.filter(F.col("_rows") > 0).select(F.inline(F.array(*structs)))


CANCELLATION_VIEWS = {
    "cancellations_by_reason": _by_reason,
    "cancellations_by_month_reason": lambda s: s.filter("is_cancelled")
        .groupBy("year", "month", _reason(s).alias("reason")).agg(_sum("flights")),
    "cancellation_code_counts": lambda s: s.groupBy("cancel_code_raw").agg(_sum("flights")),
    "delay_reason_counts": lambda s: _reasons_unpivot(s, {"flights": "positive"}),
    "delay_reason_minutes": lambda s: _reasons_unpivot(s, {"minutes": "minutes", "flights": "timed"})
        .select("reason", "minutes", "flights", exact_mean("minutes", "flights").alias("avg_minutes")),
}
