"""Runs of neighbouring times (gaps and islands), mergeable across slices of time.

Within a slice of a key, a time that follows the one before by more than
``gap`` begins a run; the running count of such marks numbers the runs, and
each run is summed to one row.  Runs of neighbouring slices that touch are
joined by the same rule, over runs instead of times.  So a task sorts at most
one slice's times or one key's runs, and a key with a third of all rows is
spread over its slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime_analytics.functions.calendar import flight_day
from ontime_analytics.functions.parse import has_delay
from ontime_analytics.operators.asof import SLICE_WIDTH
from ontime_analytics.operators.intervals import IntervalJoin, calendar_windows, overlap_join


def _numbered(df: DataFrame, by: Sequence[str], first: str, last: str, gap: int) -> DataFrame:
    """``_run``: the number of the run, among rows of a key in order of ``first`` that do not overlap."""
    order = Window.partitionBy(*by).orderBy(first)
    before = F.lag(last).over(order)
    return df.withColumn("_new", F.when(F.col(first) - before <= gap, 0).otherwise(1)) \
        .withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def runs(points: DataFrame, on: Sequence[str], time: str, sums: Sequence[str] = (), gap: int = 1, slice_width: int = SLICE_WIDTH) -> DataFrame:
    """Maximal runs of times of a key, each at most ``gap`` after the one before: keys, ``start, end, points`` and the ``sums``.

    Times are whole numbers; several rows of a key at one time are one point,
    and their sums add up.  Rows with a NULL time are left out; a NULL key is a
    key of its own."""
    per_time = points.filter(F.col(time).isNotNull()).groupBy(*on, F.col(time).cast("long").alias("_t")).agg(
        *[F.sum(c).alias(c) for c in sums], F.lit(1).cast("long").alias("points"))
    sliced = per_time.withColumn("_slice", F.floor(F.col("_t") / F.lit(slice_width)).cast("long"))
    add = [F.sum(c).cast("long").alias(c) for c in ("points", *sums)]
    short = _numbered(sliced, [*on, "_slice"], "_t", "_t", gap).groupBy(*on, "_slice", "_run").agg(F.min("_t").alias("start"), F.max("_t").alias("end"), *add)
    return _numbered(short.drop("_slice", "_run"), on, "start", "end", gap).groupBy(*on, "_run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), *add).drop("_run")


def _bad_days(flights: DataFrame, min_percent: float) -> DataFrame:
    """Per origin the days on which at least that share of the flights was delayed."""
    return flights.groupBy("origin", "year", "month", "day_of_month").agg(
        F.count(F.lit(1)).alias("flights"), F.count_if(has_delay()).alias("delayed_flights")) \
        .filter(F.col("delayed_flights") * 100 >= F.col("flights") * F.lit(min_percent)) \
        .withColumn("day", F.unix_date(flight_day()))


def airport_delay_streaks(flights: DataFrame, min_percent: float = 50.0, min_days: int = 2, slice_width: int = SLICE_WIDTH) -> DataFrame:
    """Per origin the runs of consecutive days, ``min_days`` or more, on each of which at least ``min_percent`` of the flights were delayed."""
    found = runs(_bad_days(flights, min_percent), ["origin"], "day", ["flights", "delayed_flights"], slice_width=slice_width)
    text = lambda c: F.date_from_unix_date(F.col(c).cast("int")).cast("string")
    return found.filter(F.col("points") >= min_days).select("origin", text("start").alias("first_day"), text("end").alias("last_day"), F.col("points").alias("days"),
                                                            "flights", "delayed_flights")


def streaks_in_windows(flights: DataFrame, min_percent: float = 50.0, min_days: int = 2, how: IntervalJoin = IntervalJoin()) -> DataFrame:
    """Per calendar window and year: how many airports' streaks of bad days touch it, and on how many of its days."""
    found = runs(_bad_days(flights, min_percent), ["origin"], "day").filter(F.col("points") >= min_days) \
        .select("origin", F.col("start").alias("from_day"), F.col("end").alias("to_day"))
    pairs = overlap_join(found, calendar_windows(flights), "from_day", "to_day", "start", "end", how=how)
    shared = F.least("to_day", "end") - F.greatest("from_day", "start") + 1
    return pairs.groupBy("window", "window_year").agg(
        F.count(F.lit(1)).alias("streaks"), F.countDistinct("origin").alias("airports"), F.sum(shared).cast("long").alias("shared_days"))
