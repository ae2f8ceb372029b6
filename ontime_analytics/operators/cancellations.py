"""Cancellations (Q23-Q26, and per day)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics import schema as S
from ontime_analytics.functions.parse import cancellation_reason, is_cancelled, percent


def cancellations_by_reason(flights: DataFrame) -> DataFrame:
    """Q23: cancelled flights per reason, plus the row ``All Flights`` holding
    the number of *all* flights (0 on empty input).

    The reasons are a fixed set (the code map, plus NULL for an unknown code
    on a cancelled flight), so this is one global aggregate - the total and one
    conditional count per reason, partial per task - unpivoted into rows;
    reasons that do not occur are left out, the total row always stays."""
    c = is_cancelled()
    reason = cancellation_reason()
    labels = [label for _, label in S.CANCELLATION_REASONS]
    row = flights.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(c & (reason == label)).alias(f"_r{i}") for i, label in enumerate(labels)],
        F.count_if(c & reason.isNull()).alias("_unknown"),
    )
    return _reason_rows(row, "_all", [f"_r{i}" for i in range(len(labels))], "_unknown")


def _reason_rows(row: DataFrame, total: str, per_label: list[str], unknown: str) -> DataFrame:
    """One-row counts -> (reason, flights) rows: the total, then each reason
    that occurs (labels in code-map order, then the unknown-code NULL)."""
    labels = [label for _, label in S.CANCELLATION_REASONS]
    structs = [F.struct(F.lit(S.ALL_FLIGHTS_LABEL).alias("reason"), F.col(total).alias("flights"))]
    structs += [F.struct(F.lit(label).alias("reason"), F.col(c).alias("flights"))
                for label, c in zip(labels, per_label)]
    structs.append(F.struct(F.lit(None).cast("string").alias("reason"), F.col(unknown).alias("flights")))
    rows = row.select(F.inline(F.array(*structs)))
    keep = F.coalesce(F.col("reason") == S.ALL_FLIGHTS_LABEL, F.lit(False)) | (F.col("flights") > 0)
    return rows.filter(keep).select("reason", F.col("flights").cast("long").alias("flights"))


def cancellations_by_month_reason(flights: DataFrame) -> DataFrame:
    """Q24: cancelled flights per (year, month, reason)."""
    per_code = flights.filter(is_cancelled()).groupBy("year", "month", "cancel_code").agg(F.count(F.lit(1)).alias("n"))
    # the grouped rows are labelled; all unknown codes are one NULL reason
    return per_code.groupBy("year", "month", cancellation_reason().alias("reason")).agg(F.sum("n").cast("long").alias("flights"))


def cancellations_by_day(flights: DataFrame) -> DataFrame:
    """All and cancelled flights per (year, month, day), and the share that was cancelled."""
    return flights.groupBy("year", "month", "day_of_month").agg(
        F.count(F.lit(1)).alias("flights"), F.count_if(is_cancelled()).alias("cancelled_flights")) \
        .withColumn("cancelled_percent", percent("cancelled_flights", "flights"))


def cancellations_by_carrier(flights: DataFrame) -> DataFrame:
    """Q25: all and cancelled flights per carrier (0 when none cancelled)."""
    return flights.groupBy("carrier").agg(
        F.count(F.lit(1)).alias("flights"),
        F.count_if(is_cancelled()).alias("cancelled_flights"),
    )


def cancellation_code_counts(flights: DataFrame) -> DataFrame:
    """Q26: all flights per raw cancellation code (``NA`` and empty included,
    no upper-casing)."""
    return flights.groupBy("cancel_code_raw").agg(F.count(F.lit(1)).alias("flights"))
