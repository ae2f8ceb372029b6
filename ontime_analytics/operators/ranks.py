"""Ordered windows that no hot group turns into one task's work.

Ranks of rows within a group follow from how many rows have each value: the
values are counted (map-side), a window orders a group's distinct values, and
rows get the ranks of their value by an equi-join.  No group of rows is ever
sorted, and the join's row side can be split.

Running totals are cut into slices of time like the as-of join: a window per
(key, slice), plus what the earlier slices add up to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime_analytics.functions.calendar import flight_day
from ontime_analytics.functions.parse import has_delay, percent
from ontime_analytics.operators.asof import SLICE_WIDTH


def value_ranks(df: DataFrame, by: Sequence[str], value: str, descending: bool = True) -> DataFrame:
    """Each distinct non-NULL ``value`` of a group with ``rows, rank, dense_rank, group_rows``, as SQL's RANK and DENSE_RANK number rows."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy(*by).orderBy(F.desc(value) if descending else F.asc(value))
    until = order.rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumns({
        "rank": F.sum("rows").over(until) - F.col("rows") + 1,
        "dense_rank": F.row_number().over(order).cast("long"),
        "group_rows": F.sum("rows").over(Window.partitionBy(*by)),
    })


def rank_rows(df: DataFrame, by: Sequence[str], value: str, descending: bool = True, top: int | None = None) -> DataFrame:
    """The rows with a non-NULL ``value``, and the ``rank, dense_rank, cume_dist, percent_rank`` of each within its group; with ``top``
    those of rank ``top`` or better, ties included.  NULL group keys are a group."""
    ranks = value_ranks(df, by, value, descending)
    if top is not None:
        ranks = ranks.filter(F.col("rank") <= top)
    ranks = ranks.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate((*by, value))], "rank", "dense_rank",
        ((F.col("rank") + F.col("rows") - 1) / F.col("group_rows")).alias("cume_dist"),
        F.when(F.col("group_rows") > 1, (F.col("rank") - 1) / (F.col("group_rows") - 1)).otherwise(F.lit(0.0)).alias("percent_rank"))
    meets = F.lit(True)
    for i, c in enumerate((*by, value)):
        meets = meets & df[c].eqNullSafe(F.col(f"_k{i}"))
    return df.join(ranks, meets).drop(*[f"_k{i}" for i in range(len(by) + 1)])


def running_total(df: DataFrame, by: Sequence[str], time: str, value: str, name: str, slice_width: int = SLICE_WIDTH) -> DataFrame:
    """``df``, one row per key and ``time`` (whole numbers), with the sum of ``value`` up to and including the row, as ``name``."""
    sliced = df.withColumn("_slice", F.floor(F.col(time) / F.lit(slice_width)).cast("long"))
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sliced.groupBy(*by, "_slice").agg(F.sum(value).alias("_sum")).withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))) \
        .select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate((*by, "_slice"))], "_before")
    within = Window.partitionBy(*by, "_slice").orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    inner = sliced.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    meets = F.lit(True)
    for i, c in enumerate((*by, "_slice")):
        meets = meets & inner[c].eqNullSafe(F.col(f"_k{i}"))
    return inner.join(before, meets).withColumn(name, (F.col("_within") + F.col("_before")).cast("long")).select(*df.columns, name)


def worst_departures_by_month(flights: DataFrame, k: int = 5) -> DataFrame:
    """The flights whose departure delay ranks ``k`` or better in their month of all airports and carriers, ties included."""
    rows = flights.select("year", "month", "day_of_month", "carrier", "tail_num", "origin", "dep_delay")
    return rank_rows(rows, ["year", "month"], "dep_delay", top=k).select(
        "year", "month", "rank", "dense_rank", "day_of_month", "carrier", "tail_num", "origin", "dep_delay")


def airport_rank_by_month(flights: DataFrame) -> DataFrame:
    """Each month's airports by share of delayed flights: rank, quartile, and the change of rank against the month before.

    Airports are counted per month first, so a month's window holds a row an airport."""
    monthly = flights.filter("dep_delay is not null").groupBy("year", "month", "origin").agg(
        F.count(F.lit(1)).alias("flights"), F.count_if(has_delay()).alias("delayed_flights")).withColumn("delay_percent", percent("delayed_flights", "flights"))
    best = Window.partitionBy("year", "month").orderBy(F.desc("delay_percent"), "origin")
    follow = Window.partitionBy("origin").orderBy("year", "month")
    placed = monthly.withColumns({"place": F.row_number().over(best), "quartile": F.ntile(4).over(best)})
    return placed.withColumn("moved", F.col("place") - F.lag("place").over(follow))


def carrier_running_delay(flights: DataFrame, days: int = 28, slice_width: int = SLICE_WIDTH) -> DataFrame:
    """Per carrier and day: minutes of delay, their total so far, and those of the last ``days`` calendar days."""
    daily = flights.filter(has_delay()).groupBy("carrier", "year", "month", "day_of_month").agg(F.sum("dep_delay").cast("long").alias("minutes")) \
        .withColumn("day", F.unix_date(flight_day())).filter("day is not null")
    total = running_total(daily, ["carrier"], "day", "minutes", "minutes_so_far", slice_width)
    recent = Window.partitionBy("carrier").orderBy("day").rangeBetween(-(days - 1), 0)
    return total.withColumn("recent_minutes", F.sum("minutes").over(recent)).select(
        "carrier", "year", "month", "day_of_month", "minutes", "minutes_so_far", "recent_minutes")
