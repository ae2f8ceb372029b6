"""Destinations, routes and airports' traffic, and what changes at a date.

Announced by the published programs, without code there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics import schema as S
from ontime_analytics.functions.calendar import flight_day
from ontime_analytics.functions.parse import exact_mean, has_delay, is_cancelled, percent, truncated_mean
from ontime_analytics.operators.intervals import IntervalJoin, point_join

# --- fixed values: airline mergers within the published data (absorbed, into, year, month, day of the last own flights or of the closing) ---
MERGERS = (
    ("PS", "US", 1988, 4, 9),
    ("PI", "US", 1989, 8, 5),
    ("TW", "AA", 2001, 12, 2),
    ("HP", "US", 2005, 9, 27),
    ("NW", "DL", 2008, 10, 29),
)


def destination_delays(flights: DataFrame) -> DataFrame:
    """Per destination, over flights with a parsable arrival delay: arrivals, late ones (above 15 minutes), their share and mean delay."""
    late = has_delay("arr_delay")
    counts = flights.filter(F.col("arr_delay").isNotNull()).groupBy("dest").agg(
        F.count(F.lit(1)).alias("arrivals"), F.count_if(late).alias("late_arrivals"), F.sum(F.when(late, F.col("arr_delay"))).alias("minutes"))
    return counts.select("dest", "arrivals", "late_arrivals", percent("late_arrivals", "arrivals").alias("late_percent"),
                         truncated_mean("minutes", "late_arrivals").alias("avg_delay_trunc"), exact_mean("minutes", "late_arrivals").alias("avg_delay"))


def route_delays(flights: DataFrame, min_flights: int = 1000) -> DataFrame:
    """Per (origin, destination) with ``min_flights`` or more flights that have a parsable departure delay: the share that was delayed."""
    return flights.filter(F.col("dep_delay").isNotNull()).groupBy("origin", "dest").agg(
        F.count(F.lit(1)).alias("flights"), F.count_if(has_delay()).alias("delayed_flights")) \
        .filter(F.col("flights") >= min_flights).withColumn("delay_percent", percent("delayed_flights", "flights"))


def airport_traffic(flights: DataFrame) -> DataFrame:
    """Per airport: departures, arrivals, delays and cancellations at both ends.

    Every flight counts at its origin and its destination: two rows of a key
    each, added up map-side, so there is one scan, one shuffle and no join."""
    one, none = F.lit(1), F.lit(0)
    flag = lambda c: F.when(c, one).otherwise(none)
    ends = F.array(
        F.struct(F.col("origin").alias("airport"), one.alias("d"), none.alias("a"), flag(has_delay()).alias("dd"), none.alias("ad"), flag(is_cancelled()).alias("c")),
        F.struct(F.col("dest").alias("airport"), none.alias("d"), one.alias("a"), none.alias("dd"), flag(has_delay("arr_delay")).alias("ad"), none.alias("c")))
    names = {"d": "departures", "a": "arrivals", "dd": "delayed_departures", "ad": "late_arrivals", "c": "cancelled_departures"}
    return flights.select(F.inline(ends)).groupBy("airport").agg(*[F.sum(k).cast("long").alias(n) for k, n in names.items()])


def before_and_after(flights: DataFrame, events: DataFrame, days: int = 90, how: IntervalJoin = IntervalJoin()) -> DataFrame:
    """Per event and phase, the flights of its carriers in the ``days`` before and from its day on.

    ``events``: ``event, carrier, day`` (a day number); an event may name
    several carriers, a carrier several events.  Flights are counted per
    carrier and day first and meet the phases in an interval join on the
    carrier; a phase without flights has no row."""
    phases = events.select("event", "carrier", F.inline(F.array(
        F.struct(F.lit("before").alias("phase"), (F.col("day") - days).alias("start"), (F.col("day") - 1).alias("end")),
        F.struct(F.lit("after").alias("phase"), F.col("day").alias("start"), (F.col("day") + days - 1).alias("end")))))
    daily = flights.groupBy("carrier", "year", "month", "day_of_month").agg(
        F.count(F.lit(1)).alias("flights"), F.count_if(has_delay()).alias("delayed_flights"), F.count_if(is_cancelled()).alias("cancelled_flights")) \
        .withColumn("at", F.unix_date(flight_day())).drop("year", "month", "day_of_month")
    return point_join(daily, phases, "at", on=["carrier"], how=how).groupBy("event", "phase").agg(
        *[F.sum(c).cast("long").alias(c) for c in ("flights", "delayed_flights", "cancelled_flights")]) \
        .withColumn("delay_percent", percent("delayed_flights", "flights"))


def merger_impact(flights: DataFrame, mergers=MERGERS, days: int = 90) -> DataFrame:
    """Delays and cancellations of both carriers of a merger in the ``days`` before it and after."""
    rows = [f"('{a} into {b}', '{c}', unix_date(make_date({y}, {m}, {d})))" for a, b, y, m, d in mergers for c in (a, b)]
    events = flights.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS e(event, carrier, day)")
    return before_and_after(flights, events, days)
