"""Stand-in inputs derived from the driver's test tables.

The driver ships TPC-H-style tables, not flight files.  The ``*_from_*``
builders only give rows in the raw schemas the jobs expect (flight fields as
STRING, registry lines as fixed-width text) - no parsing, typing, joining or
aggregating.  The derivation is fixed by ``FIXTURES.md`` (B1-B4) so that the
DuckDB oracle can build the very same rows; for the flights it is a pure
projection of ``lineitem`` (no shuffle), so column pruning reaches the scan.

``fixture_flights`` / ``fixture_registry`` then wire those rows into the
library's own steps, exactly as for real files: typing (S1,
:func:`type_flights`) and the registry parsers (S2/S3).  Nothing is kept
between calls: each call plans on the files as they are then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_analytics import schema as S
from ontime_analytics.sources.flights import type_flights
from ontime_analytics.sources.registry import parse_model_lookup, parse_registry_master


def _s(c: Column) -> Column:
    return c.cast("string")


def part_key(key: Column) -> Column:
    """A part's key in at most five characters (base 36), which stays unique below 36^5 parts."""
    return F.conv(_s(key), 10, 36)


def dealt_evenly(rows: DataFrame) -> DataFrame:
    """The same rows, dealt in turn to a multiple of the cluster's cores.

    A Parquet row group is read by one task, however large it is: what follows
    the scan would run in as many tasks as the table has row groups.  Tasks of
    one size also give files of one size, which readers pack evenly."""
    cores = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    scans = cores if rows.isStreaming else rows.rdd.getNumPartitions()
    return rows.repartition(cores * max(1, -(-scans // cores)))


def flights_raw_from_lineitem(lineitem: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """B1: one raw flight row per ``lineitem`` row (18 used raw columns), and the columns in ``keep``."""
    c = F.col
    ship = c("l_shipdate")
    qty = c("l_quantity").cast("int")
    line = c("l_linenumber")
    part = c("l_partkey")
    supp = c("l_suppkey")
    status = c("l_linestatus")
    yr = F.year(ship)
    cancelled_row = (c("l_returnflag") == "R") & (line == 1)
    return lineitem.select(
        _s(yr).alias("Year"),
        _s(F.month(ship)).alias("Month"),
        _s(F.dayofmonth(ship)).alias("DayofMonth"),
        _s(F.weekday(ship) + 1).alias("DayOfWeek"),
        F.concat(F.lit("C"), _s(supp % 17)).alias("UniqueCarrier"),
        F.when(line == 6, F.lit("NA")).otherwise(F.concat(F.lit("N"), part_key(part))).alias("TailNum"),
        F.when(line == 7, F.lit("NA"))
        .otherwise(_s(qty * 2 - 50 + (supp % 9).cast("int"))).alias("ArrDelay"),
        F.when((line == 7) & (status == "O"), F.lit("NA"))
        .when(line == 7, F.lit(""))
        .when(part % 97 == 0, F.lit(" 20"))
        .otherwise(_s(qty * 3 - 90 + (part % 31).cast("int"))).alias("DepDelay"),
        F.concat(F.lit("A"), _s(part % 120)).alias("Origin"),
        F.concat(F.lit("A"), _s((part * 7 + supp) % 120)).alias("Dest"),
        F.when((line == 5) & (status == "F"), F.lit("NA"))
        .otherwise(_s(F.floor(c("l_extendedprice") / 18).cast("int"))).alias("Distance"),
        F.when(cancelled_row, F.lit("1")).when(line == 2, F.lit("x"))
        .otherwise(F.lit("0")).alias("Cancelled"),
        F.when(cancelled_row,
               F.when(supp % 5 == 0, "A").when(supp % 5 == 1, "b").when(supp % 5 == 2, "C")
               .when(supp % 5 == 3, "D").otherwise("Z"))
        .when(status == "O", F.lit("NA")).otherwise(F.lit("")).alias("CancellationCode"),
        F.when(yr < 1998, F.lit("NA")).otherwise(_s(qty % 7)).alias("CarrierDelay"),
        F.when(yr < 1998, F.lit("NA")).otherwise(_s(qty % 5)).alias("WeatherDelay"),
        F.when(yr < 1998, F.lit("NA")).otherwise(_s((part % 4).cast("int"))).alias("NASDelay"),
        F.when(yr < 1998, F.lit("")).otherwise(_s((supp % 3).cast("int"))).alias("SecurityDelay"),
        F.when(yr < 1999, F.lit("NA")).otherwise(_s((part % 11).cast("int"))).alias("LateAircraftDelay"),
        *keep,
    )


def flight_lines_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The rows of B1 as text lines of 29 fields joined by commas, the fields
    that B1 lacks empty; one line in ten ends after 16 fields, one in ten has a 30th."""
    raw = flights_raw_from_lineitem(lineitem, keep=("l_orderkey",))
    fields = [F.col(c) if c in raw.columns else F.lit("") for c in S.RAW_COLUMNS]
    kind = F.col("l_orderkey") % 10
    return raw.select(F.when(kind == 0, F.concat_ws(",", *fields[:16]))
                      .when(kind == 1, F.concat_ws(",", *fields, F.lit("more")))
                      .otherwise(F.concat_ws(",", *fields)).alias("value"))


def master_lines_from_part(part: DataFrame) -> DataFrame:
    """B2: fixed-width MASTER lines (every tenth part unregistered)."""
    c = F.col
    return part.filter(c("p_partkey") % 10 != 0).select(
        F.concat(F.rpad(part_key(c("p_partkey")), 5, " "), F.lit(" " * 32),
                 F.lpad(_s(c("p_size")), 6, "0")).alias("value"))


def model_lines_from_part(part: DataFrame) -> DataFrame:
    """Fixed-width ACFTREF lines (model codes divisible by 13 missing)."""
    c = F.col
    return part.filter(c("p_size") % 13 != 0).select(
        F.concat(F.lpad(_s(c("p_size")), 6, "0"), F.lit(" " * 33),
                 F.rpad(F.concat(F.lit("MODEL-"), _s(c("p_size"))), 19, " ")).alias("value")
    ).distinct()


def fixture_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed flights from ``{sf_dir}/lineitem.parquet``."""
    return type_flights(flights_raw_from_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet")))


def fixture_flight_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flight lines from ``{sf_dir}/lineitem.parquet``."""
    return flight_lines_from_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def fixture_registry(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(master, model lookup) parsed from lines derived from ``part``."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return (parse_registry_master(master_lines_from_part(part)), parse_model_lookup(model_lines_from_part(part)))
