"""Streaming aggregates over arriving flight files: event days, late rows, lines delivered twice.

Event time is the day of the flight.  A day's counts are kept in state until
the watermark - the latest day seen, less ``late_after`` - has passed it; then
they are written once (append mode) and the state is dropped, so it holds the
open days only.  Rows of a day that was closed before they came are left out
of the stream's result; :func:`late_flights` finds them by comparing that result
with a batch count of the lake, so they are counted apart and not lost.

A line that was delivered before, in this file or another, is dropped as long
as its key is in state: until the watermark has passed its day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ontime_analytics import schema as S
from ontime_analytics.functions.calendar import flight_day
from ontime_analytics.functions.parse import has_delay, is_cancelled, strict_int
from ontime_analytics.session import streaming_checkpoint
from ontime_analytics.sources.flights import FIELDS_COLUMN, parse_flight_lines, type_flights

LATE_AFTER = "7 days"
EVENT_COLUMN = "event"
#: Where the three date fields stand in a line.
_DATE_FIELDS = tuple(S.RAW_COLUMNS.index(c) for c in ("Year", "Month", "DayofMonth"))


def with_event_time(flights: DataFrame) -> DataFrame:
    """The flights that have a date, with it as a timestamp."""
    return flights.withColumn(EVENT_COLUMN, flight_day().cast("timestamp")).filter(F.col(EVENT_COLUMN).isNotNull())


def daily_delays(flights: DataFrame, late_after: str = LATE_AFTER) -> DataFrame:
    """Per event day: ``day, day_of_week, flights, delayed_flights, cancelled_flights, delay_minutes``.

    On a stream the watermark closes days; on a batch it has no effect and all days are there."""
    minutes = F.when(has_delay(), F.col("dep_delay")).otherwise(F.lit(0))
    return with_event_time(flights).withWatermark(EVENT_COLUMN, late_after).groupBy(F.window(EVENT_COLUMN, "1 day")).agg(
        F.count(F.lit(1)).alias("flights"), F.count_if(has_delay()).alias("delayed_flights"), F.count_if(is_cancelled()).alias("cancelled_flights"),
        F.sum(minutes).cast("long").alias("delay_minutes")) \
        .select(F.to_date("window.start").alias("day"), (F.weekday("window.start") + 1).alias("day_of_week"),
                "flights", "delayed_flights", "cancelled_flights", "delay_minutes")


def drop_repeated_lines(lines: DataFrame, late_after: str = LATE_AFTER, value: str = "value") -> DataFrame:
    """The lines without those that came before and whose day the watermark has not passed.

    Lines without a date have no event time to expire by and are all kept."""
    # only as far as the date's last field, and in a projection of its own, so that it is split once
    begun = lines.withColumn(FIELDS_COLUMN, F.split(F.substring_index(F.col(value), ",", max(_DATE_FIELDS) + 1), ","))
    year, month, day = (strict_int(F.try_element_at(FIELDS_COLUMN, F.lit(i + 1))) for i in _DATE_FIELDS)
    event = flight_day(year, month, day).cast("timestamp").alias(EVENT_COLUMN)
    # through a generator of one row, which filters do not pass: below it they would build and split the line at every mention
    dated = begun.select(F.inline(F.array(F.struct(*lines.columns, event))))
    once = dated.filter(F.col(EVENT_COLUMN).isNotNull()).withWatermark(EVENT_COLUMN, late_after).dropDuplicatesWithinWatermark([value])
    return once.drop(EVENT_COLUMN).unionByName(dated.filter(F.col(EVENT_COLUMN).isNull()).drop(EVENT_COLUMN))


def start_daily_delays(spark: SparkSession, source_dir: str, out: str, checkpoint_location: str, late_after: str = LATE_AFTER, header: bool = True,
                       available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream new files of ``source_dir`` into the closed days' counts in ``out`` (Parquet, append).

    A restart with the same checkpoint goes on with the open days' state; each
    file is read once and each closed day written once."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    daily = daily_delays(type_flights(parse_flight_lines(reader.load(source_dir), header=header)), late_after)
    return _started(daily, out, checkpoint_location, available_now)


def _started(df: DataFrame, out: str, checkpoint_location: str, available_now: bool = True) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint_location).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def late_flights(lake_flights: DataFrame, streamed: DataFrame) -> DataFrame:
    """Per closed day ``late_flights``: the flights that the lake has and the streamed counts lack.

    Days after the last streamed one are open and not compared; a day that was
    closed before any of its flights came is late as a whole."""
    have = streamed.groupBy("day").agg(F.sum("flights").cast("long").alias("counted"))
    last = streamed.agg(F.max("day").alias("last"))
    every = daily_delays(lake_flights).groupBy("day").agg(F.sum("flights").cast("long").alias("present"))
    closed = every.join(F.broadcast(last), every["day"] <= F.col("last"))
    return closed.join(have, "day", "left").select("day", (F.col("present") - F.coalesce("counted", F.lit(0))).alias("late_flights")).filter("late_flights > 0")


# ---- the driver's queries: the same streams, over its tables as files -------------------------

def _stream_of(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The table as a stream of files; a pattern, since a stream's path must be a folder or match files."""
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/[{table[0]}]{table[1:]}.parquet")


def _all_at_once(df: DataFrame, name: str) -> DataFrame:
    """Run the stream over what is there, and read what it has written."""
    import uuid

    spark = df.sparkSession
    place = streaming_checkpoint(spark, f"{name}-{uuid.uuid4().hex}")
    _started(df, f"{place}/out", f"{place}/state").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{place}/out")


def streamed_daily_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days that the watermark has closed when all of ``lineitem`` has streamed through."""
    from ontime_analytics.sources.fixture import flights_raw_from_lineitem

    flights = type_flights(flights_raw_from_lineitem(_stream_of(spark, sf_dir, "lineitem")))
    return _all_at_once(daily_delays(flights).withColumn("day", F.col("day").cast("string")), "daily")


def streamed_distinct_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per year when every line is delivered twice, by two sources, and counts once."""
    from ontime_analytics.sources.fixture import dealt_evenly, flight_lines_from_lineitem

    lines = flight_lines_from_lineitem(dealt_evenly(_stream_of(spark, sf_dir, "lineitem")))
    again = flight_lines_from_lineitem(dealt_evenly(_stream_of(spark, sf_dir, "lineitem")))
    once = _all_at_once(drop_repeated_lines(lines.unionByName(again)), "lines")
    return type_flights(parse_flight_lines(once)).groupBy("year").agg(F.count(F.lit(1)).alias("lines"))


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "streamed_daily_delays": streamed_daily_delays,
    "streamed_distinct_lines": streamed_distinct_lines,
}
