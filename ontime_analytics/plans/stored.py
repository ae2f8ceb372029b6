"""Queries that go through files: what a writer stored, read back, and a lake loaded twice.

Each writes to a new folder under ``spark.checkpoint.dir`` and returns what a
reader finds there.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_analytics.plans.catalog import build
from ontime_analytics.session import checkpoint_dir
from ontime_analytics.sinks import write_csv, write_json
from ontime_analytics.sources.fixture import dealt_evenly, fixture_flights, flight_lines_from_lineitem
from ontime_analytics.sources.flights import read_flights
from ontime_analytics.sources.ingest import ingest_flights


def _folder(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _read_back(name: str, kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result, path = build(name, fixture_flights(spark, sf_dir)), _folder(spark, f"stored-{name}")
        if kind == "csv":
            write_csv(result, path, single_file=True)
            return spark.read.schema(result.schema).csv(path)
        write_json(result, path, single_file=True)
        return spark.read.schema(result.schema).json(path)

    run.__doc__ = f"{name}, written as {kind} and read back."
    return run


def ingested_lake_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines as files, loaded into a lake and loaded again (which replaces every row): totals per year."""
    raw, lake = _folder(spark, "raw-lines"), _folder(spark, "lake")
    lineitem = dealt_evenly(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))  # before the lines are built and compressed
    flight_lines_from_lineitem(lineitem).write.text(raw, compression="bzip2")
    for _ in range(2):
        ingest_flights(spark, raw, lake, header=False)
    return read_flights(spark, lake).groupBy("year").agg(
        F.count(F.lit(1)).alias("flights"), F.sum("dep_delay").alias("dep_delay_minutes"), F.sum("distance").alias("miles"))


STORED_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stored_csv_one_value": _read_back("delays_by_month", "csv"),
    "stored_csv_two_values": _read_back("delay_by_year", "csv"),
    "stored_json": _read_back("airport_average_delay", "json"),
    "ingested_lake_totals": ingested_lake_totals,
}
#: The stored results are those of the queries themselves.
SAME_AS = {"stored_csv_one_value": "delays_by_month", "stored_csv_two_values": "delay_by_year", "stored_json": "airport_average_delay"}
