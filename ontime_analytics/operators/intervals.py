"""Interval joins as equi-joins on bins.

An interval stands in every bin of ``bin_width`` that it meets, a point in one;
rows of one bin are compared exactly.  A point meets an interval in one bin
only, and two intervals are compared in the bin where the later one begins, so
each pair comes once.  The width follows the mean length of the intervals: then
an interval stands in about two bins.

The intervals are measured before.  Small ones are broadcast and the points
are not shuffled at all; beyond the bound both sides are shuffled, and a bin
is dealt out over ``salts`` so that one with a third of all points is not one
task's work.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_analytics.functions.calendar import flight_day
from ontime_analytics.functions.parse import has_delay, is_cancelled, percent

# name, first month and day, last month and day; a last day before the first lies in the next year
WINDOWS = (
    ("New Year", 12, 28, 1, 4),
    ("Spring break", 3, 10, 4, 10),
    ("Independence Day", 6, 30, 7, 7),
    ("Summer", 6, 15, 8, 31),
    ("Thanksgiving", 11, 20, 12, 1),
    ("Christmas", 12, 18, 12, 31),
    ("Winter", 12, 1, 2, 28),
)


@dataclass(frozen=True)
class IntervalJoin:
    """How the two sides meet; ``bin_width`` None takes the intervals' mean length, as a power of two."""
    broadcast_max_bytes: int = 64 << 20
    bin_width: int | None = None
    salts: int = 16


def _measured(intervals: DataFrame, start: str, end: str, how: IntervalJoin) -> tuple[int, bool]:
    """(bin width, whether the binned intervals may be broadcast)."""
    length = F.col(end) - F.col(start) + 1
    m = intervals.agg(F.count(F.lit(1)).alias("n"), F.sum(length.cast("double")).alias("total")).first()
    width = how.bin_width or 1 << max(0, round(m["total"] / m["n"]).bit_length() - 1 if m["n"] else 0)
    bins = (m["total"] or 0) / width + 2 * m["n"]
    # a bound by the plan's own column types: fixed widths, and strings as measured
    fixed = 64 + 16 * (len(intervals.columns) + 1)
    strings = [c for c, t in intervals.dtypes if t not in ("int", "bigint", "date", "double", "boolean", "smallint", "tinyint", "float")]
    most = intervals.agg(F.max(sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in strings), F.lit(0))).alias("m")).first()["m"] if strings and m["n"] else 0
    return width, bins * (fixed + (most or 0)) <= how.broadcast_max_bytes


def _binned(intervals: DataFrame, start: str, end: str, width: int) -> DataFrame:
    at = lambda c: F.floor(F.col(c) / F.lit(width))
    return intervals.withColumn("_bin", F.explode(F.sequence(at(start), at(end))))


def _joined(left: DataFrame, right: DataFrame, on: Sequence[str], matches, small: bool, how: IntervalJoin, join_type: str) -> DataFrame:
    """``right`` is the binned intervals; keys of the same name are kept once, from ``left``."""
    renamed = right
    for k in on:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    condition = (left["_bin"] == renamed["_b"]) & matches(left, renamed)
    for k in on:
        condition = condition & (left[k] == renamed[f"_r_{k}"])
    if small:
        out = left.join(F.broadcast(renamed), condition, join_type)
    else:
        salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(how.salts)))
        copies = renamed.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(how.salts - 1).cast("long"))))
        condition = (salted["_bin"] == copies["_b"]) & (salted["_salt"] == copies["_s"]) & matches(salted, copies)
        for k in on:
            condition = condition & (salted[k] == copies[f"_r_{k}"])
        out = salted.join(copies.hint("shuffle_merge"), condition, join_type)
    return out.drop("_bin", "_b", "_salt", "_s", *[f"_r_{k}" for k in on])


def point_join(points: DataFrame, intervals: DataFrame, point: str, start: str = "start", end: str = "end", on: Sequence[str] = (),
               how: IntervalJoin = IntervalJoin(), join_type: str = "inner") -> DataFrame:
    """Each row of ``points`` with each interval that holds its ``point`` (both ends included) and agrees in the keys ``on``.

    Points and ends are whole numbers.  NULL points, ends and keys match
    nothing (with ``join_type`` left, such points stay), nor do intervals that
    end before they start.  Equal intervals count each.  Columns must differ
    between the two sides, but for the keys."""
    good = intervals.filter(F.col(start) <= F.col(end))
    width, small = _measured(good, start, end, how)
    left = points.withColumn("_bin", F.floor(F.col(point) / F.lit(width)))
    right = _binned(good, start, end, width).withColumnRenamed("_bin", "_b")
    return _joined(left, right, on, lambda a, b: a[point].between(b[start], b[end]), small, how, join_type)


def overlap_join(left: DataFrame, right: DataFrame, left_start: str, left_end: str, right_start: str, right_end: str, on: Sequence[str] = (),
                 how: IntervalJoin = IntervalJoin()) -> DataFrame:
    """Each pair of rows whose intervals share a point, once.  Rules as for :func:`point_join`."""
    a, b = left.filter(F.col(left_start) <= F.col(left_end)), right.filter(F.col(right_start) <= F.col(right_end))
    width, small = _measured(b, right_start, right_end, how)
    x = _binned(a, left_start, left_end, width)
    y = _binned(b, right_start, right_end, width).withColumnRenamed("_bin", "_b")

    def matches(p: DataFrame, q: DataFrame) -> Column:
        first = F.floor(F.greatest(p[left_start], q[right_start]) / F.lit(width))
        return (p[left_start] <= q[right_end]) & (q[right_start] <= p[left_end]) & (p["_bin"] == first)

    return _joined(x, y, on, matches, small, how, "inner")


def calendar_windows(flights: DataFrame, windows=WINDOWS) -> DataFrame:
    """The windows of every year that the flights cover: ``window, window_year`` (of the first day), ``start, end`` as day numbers."""
    # two numbers; fewer than 10,000 years have dates, and a window that began the year before reaches into the first
    first, last = flights.filter(F.col("year").between(1, 9999)).agg(F.min("year"), F.max("year")).first()
    years = flights.sparkSession.range(max((first or 1) - 1, 1), min(last or 0, 9998) + 1).select(F.col("id").cast("int").alias("window_year"))
    rows = F.array(*[F.struct(F.lit(n).alias("window"), *[F.lit(x).alias(k) for k, x in zip(("m1", "d1", "m2", "d2"), ends)]) for n, *ends in windows])
    day = lambda y, m, d: F.unix_date(F.make_date(y, m, d))
    turns = F.when(F.col("m2") * 100 + F.col("d2") < F.col("m1") * 100 + F.col("d1"), F.col("window_year") + 1).otherwise(F.col("window_year"))
    return years.select("window_year", F.inline(rows)).select(
        "window", "window_year", day(F.col("window_year"), F.col("m1"), F.col("d1")).alias("start"), day(turns, F.col("m2"), F.col("d2")).alias("end"))


def holiday_window_delays(flights: DataFrame, how: IntervalJoin = IntervalJoin()) -> DataFrame:
    """Per calendar window and year: flights, delayed and cancelled ones; windows overlap, and a flight counts in each that holds it.

    The flights are counted per day first, so a bin never holds more than its days."""
    daily = flights.groupBy("year", "month", "day_of_month").agg(
        F.count(F.lit(1)).alias("flights"), F.count_if(has_delay()).alias("delayed_flights"), F.count_if(is_cancelled()).alias("cancelled_flights")) \
        .withColumn("day", F.unix_date(flight_day())).drop("year", "month", "day_of_month")
    return point_join(daily, calendar_windows(flights), "day", how=how).groupBy("window", "window_year").agg(
        *[F.sum(c).cast("long").alias(c) for c in ("flights", "delayed_flights", "cancelled_flights")]) \
        .withColumn("delay_percent", percent("delayed_flights", "flights"))
