"""As-of join: for each row the latest earlier row of the same key.

There is no range join.  Both sides become points (key, time), one row each,
by an aggregate that combines map-side; the answer of a point is the last value
seen before it.  So that a key with very many times is not one task's work,
times are cut into slices: a window per (key, slice) finds the last value
within, and what earlier slices leave is carried into each slice as one more
point.  A slice holds at most ``slice_width`` times a key, however many rows
stand behind them.  The points then meet the rows on (key, time) in an
equi-join whose row side AQE can split, since each point is there once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime_analytics import schema as S
from ontime_analytics.functions.calendar import flight_day
from ontime_analytics.functions.parse import has_delay, percent, tail_key

#: Times in one slice (days, where times are days).
SLICE_WIDTH = 32


def _points(df: DataFrame, on: Sequence[str], time: str, value: Column, asked: bool) -> DataFrame:
    given = df.filter(F.col(time).isNotNull())
    for k in on:
        given = given.filter(F.col(k).isNotNull())
    return given.select(*on, F.col(time).cast("long").alias("_time"), value.alias("_value"), F.lit(asked).alias("_asked"))


def _with_last(points: DataFrame, on: Sequence[str], strict: bool, slice_width: int) -> DataFrame:
    """``points`` (one row per key and ``_time``, ``_value`` a struct or NULL) with ``_found``: (time, value) of the key's
    latest point with a value before each, or at it."""
    sliced = points.withColumn("_slice", F.floor(F.col("_time") / F.lit(slice_width)).cast("long"))
    here = F.when(F.col("_value").isNotNull() & F.col("_time").isNotNull(), F.struct(F.col("_time").alias("time"), F.col("_value").alias("value")))
    # times rise within a key, so the greatest (time, value) of the earlier slices is the last one
    earlier = Window.partitionBy(*on).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (sliced.groupBy(*on, "_slice").agg(F.max(here).alias("_last"))
               .withColumn("_last", F.max("_last").over(earlier)).filter(F.col("_last").isNotNull())
               .select(*on, F.col("_last.time").alias("_time"), F.col("_last.value").alias("_value"), F.lit(False).alias("_asked"), "_slice"))
    within = Window.partitionBy(*on, "_slice").orderBy("_time").rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    return sliced.unionByName(carried).withColumn("_found", F.last(here, ignorenulls=True).over(within)).filter("_asked")


def with_previous(points: DataFrame, on: Sequence[str], time: str, values: Sequence[str], prefix: str = "prev_", slice_width: int = SLICE_WIDTH) -> DataFrame:
    """``points``, one row per key and time, with ``<prefix>time`` and the ``values`` of the key's row before.

    Rows with a NULL key or time have none before them.  Nothing is joined: a
    point's own columns travel with it, and ``points`` is computed once."""
    rest = [c for c in points.columns if c not in on]
    # all columns go into the value, so that both uses of the points are the same exchange
    given = points.select(*on, F.col(time).cast("long").alias("_time"), F.struct(*rest).alias("_value"), F.lit(True).alias("_asked"))
    found = F.when(F.col("_time").isNotNull() & F.expr(" and ".join(f"`{k}` is not null" for k in on)), F.col("_found"))
    return _with_last(given, on, True, slice_width).withColumn("_found", found).select(
        *[F.col(c) if c in on else F.col("_value")[c].alias(c) for c in points.columns],
        F.col("_found.time").alias(f"{prefix}time"), *[F.col("_found.value")[v].alias(f"{prefix}{v}") for v in values])


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, values: Sequence[str], prefix: str = "prev_",
              strict: bool = True, tolerance: int | None = None, slice_width: int = SLICE_WIDTH) -> DataFrame:
    """``left`` with ``<prefix>time`` and the ``values`` of the latest row of ``right`` with the same keys and an earlier time.

    Times are whole numbers (days, seconds).  Without ``strict`` an equal time
    counts too; with ``tolerance`` a row further back does not.  Of several
    rows of ``right`` at that time, the greatest by ``values`` in their order
    is taken.  Rows of ``left`` with a NULL key or time, or without an earlier
    row, keep NULLs; NULL keys and times of ``right`` match nothing.
    """
    value = F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    kind = right.select(value.alias("v")).schema["v"].dataType
    asked = _points(left, on, left_time, F.lit(None).cast(kind), True)
    given = _points(right, on, right_time, value, False)
    points = given.unionByName(asked).groupBy(*on, "_time").agg(F.max("_value").alias("_value"), F.bool_or("_asked").alias("_asked"))
    answers = _with_last(points, on, strict, slice_width)
    if tolerance is not None:
        answers = answers.withColumn("_found", F.when(F.col("_time") - F.col("_found.time") <= tolerance, F.col("_found")))
    answers = answers.select(*[F.col(k).alias(f"_on{i}") for i, k in enumerate(on)], "_time", "_found")
    meets = F.col(left_time).cast("long") == F.col("_time")
    for i, k in enumerate(on):
        meets = meets & (left[k] == F.col(f"_on{i}"))
    return left.join(answers, meets, "left").select(
        *left.columns, F.col("_found.time").alias(f"{prefix}time"), *[F.col(f"_found.value.v{i}").alias(f"{prefix}{v}") for i, v in enumerate(values)])


def _departures(flights: DataFrame) -> DataFrame:
    """The columns used here, with the day as a number and the registry key of the tail (NULL for ``NA``)."""
    known = F.when(F.col("tail_num") != "NA", tail_key("tail_num"))
    return flights.select("year", "month", "day_of_month", known.alias("tail"), "origin", "dep_delay", F.unix_date(flight_day()).alias("day"))


def previous_departures(flights: DataFrame) -> DataFrame:
    """Every flight with its aircraft's latest earlier day of flying: how many days ago, and that day's most delayed departure.

    The files give days, so the order within a day is not known.  Flights with an unknown tail or no valid date have no earlier one."""
    df = _departures(flights)
    worst = df.filter("tail is not null and day is not null").groupBy("tail", "day").agg(F.max(F.struct("dep_delay", "origin")).alias("worst"))
    days = with_previous(worst, ["tail"], "day", ["worst"]).select(F.col("tail").alias("_tail"), F.col("day").alias("_day"), "prev_time", "prev_worst")
    return df.join(days, (df["tail"] == days["_tail"]) & (df["day"] == days["_day"]), "left").select(
        "year", "month", "day_of_month", "tail", "origin", "dep_delay", (F.col("day") - F.col("prev_time")).cast("int").alias("days_since"),
        F.col("prev_worst.origin").alias("previous_origin"), F.col("prev_worst.dep_delay").alias("previous_delay"))


def previous_departure_impact(flights: DataFrame) -> DataFrame:
    """Flights and delayed flights by how long ago the aircraft flew before and whether that day's worst departure was delayed.

    The flights are counted per aircraft and day first; each such count meets the one before."""
    daily = _departures(flights).groupBy("tail", "day").agg(
        F.count(F.lit(1)).alias("flights"), F.count_if(has_delay()).alias("delayed_flights"),
        F.max("dep_delay").alias("worst"))
    out = with_previous(daily, ["tail"], "day", ["worst"])
    gap = F.col("day") - F.col("prev_time")
    band = F.when(gap == 1, "the day before").when(gap <= 7, "2 to 7 days").when(gap <= 30, "8 to 30 days").when(gap > 30, "longer").otherwise("none known")
    return out.groupBy(band.alias("last_flown"), F.when(gap.isNotNull(), F.coalesce(F.col("prev_worst") > S.DELAY_THRESHOLD_MINUTES, F.lit(False))).alias("was_delayed")).agg(
        F.sum("flights").cast("long").alias("flights"), F.sum("delayed_flights").cast("long").alias("delayed_flights")) \
        .withColumn("delay_percent", percent("delayed_flights", "flights"))
