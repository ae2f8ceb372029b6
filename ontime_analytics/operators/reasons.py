"""Delay reasons (Q27, Q28).

The five reason columns are aggregated in one pass (five conditional
aggregates in a single global aggregate), and only the one-row result is
unpivoted to one row per reason - instead of exploding every flight into five
rows before aggregating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics import schema as S
from ontime_analytics.functions.parse import exact_mean


def _unpivot(row: DataFrame, fields: list[str]) -> DataFrame:
    """One row with ``{label}__{field}`` columns -> one row per reason label;
    nothing for empty input (``_rows`` = 0), where there is no pair to count."""
    structs = [F.struct(F.lit(label).alias("reason"),
                        *[F.col(f"{label}__{f}").alias(f) for f in fields])
               for label, _ in S.DELAY_REASONS]
    return row.filter(F.col("_rows") > 0).select(F.inline(F.array(*structs)))


def delay_reason_counts(flights: DataFrame) -> DataFrame:
    """Q27: per reason, flights with a parsed delay above zero; all five kept."""
    row = flights.agg(F.count(F.lit(1)).alias("_rows"),
                      *[F.count_if(F.col(c) > 0).alias(f"{label}__flights")
                        for label, c in S.DELAY_REASONS])
    return _unpivot(row, ["flights"])


def delay_reason_minutes(flights: DataFrame) -> DataFrame:
    """Q28: per reason, total minutes and number of flights with a parsable
    value (zeros count), plus their mean."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for label, c in S.DELAY_REASONS:
        aggs.append(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"{label}__minutes"))
        aggs.append(F.count(c).alias(f"{label}__flights"))
    out = _unpivot(flights.agg(*aggs), ["minutes", "flights"])
    return out.select("reason", "minutes", "flights",
                      exact_mean("minutes", "flights").alias("avg_minutes"))
