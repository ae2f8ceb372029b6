"""Land flight files in a typed Parquet lake, partitioned by ``year`` and ``load``.

One Spark job replaces "download, bunzip2, strip the header, hdfs put":
``*.csv.bz2`` is read natively (bzip2 is splittable, so one large yearly file
is read by many tasks), typed once, and written.

``load`` names the input file a row came from and the run that loaded it.
Loading a file again replaces what it gave before - also in years it no longer
has - and nothing else, and it does so in one step (:mod:`.loads`): a run that
breaks off leaves the rows as they were.  Rows whose year does not parse keep
their file's load under a NULL year.

No shuffle: every task writes the files it read.  Each task sorts its own rows
by (year, month, day) before writing, so Parquet row-group statistics let date
filters (e.g. the daylight-saving days) skip row groups; ``maxRecordsPerFile``
bounds the output file size.  A failed task is simply re-run; the commit
protocol makes the output appear atomically.

A lake is written either by these batch loads or by one file stream
(:mod:`ontime_analytics.streaming.ingest`), never by both: a stream's metadata
log hides files it did not write.  :func:`read_flights` reads several lakes.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_analytics.sources.flights import LOAD_COLUMN, parse_flight_lines, type_flights
from ontime_analytics.sources.loads import RUN_MARK, Journal

DEFAULT_MAX_RECORDS_PER_FILE = 20_000_000
STREAM_LOG = "_spark_metadata"


def load_key(path: Column) -> Column:
    """A file's load: its name and a hash of its whole path, so that files of
    one name in two folders stay apart."""
    return F.concat(F.substring_index(path, "/", -1), F.lit("~"), F.lower(F.hex(F.xxhash64(path))))


def _paths(spark: SparkSession, *globs: str) -> set[str]:
    """The paths that match, through the Hadoop file system that holds them."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = set()
    for g in globs:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(g)
        out |= {str(s.getPath()) for s in p.getFileSystem(conf).globStatus(p) or []}
    return out


def is_stream_lake(spark: SparkSession, lake: str) -> bool:
    return bool(_paths(spark, f"{lake}/{STREAM_LOG}"))


def has_batch_files(spark: SparkSession, lake: str) -> bool:
    return bool(_paths(spark, f"{lake}/year=*")) and not is_stream_lake(spark, lake)


def write_flights_lake(typed: DataFrame, lake: str, mode: str = "overwrite",
                       max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
                       sort_within: tuple[str, ...] = ("month", "day_of_month"),
                       load: str = "all") -> None:
    """Write typed flights to the lake; without a ``load`` column they are one load named ``load``.

    With ``mode="overwrite"`` each load that occurs replaces its own (year, load)
    partitions; years of a load that the rows no longer have stay (:func:`ingest_flights`
    replaces whole files)."""
    spark = typed.sparkSession
    if is_stream_lake(spark, lake):
        raise ValueError(f"{lake} is written by a stream; load into a folder of its own and read both")
    if LOAD_COLUMN not in typed.columns:
        typed = typed.withColumn(LOAD_COLUMN, F.lit(load))
    if sort_within:
        typed = typed.sortWithinPartitions("year", LOAD_COLUMN, *sort_within)
    (typed.write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file)
     .option("compression", "zstd")
     .partitionBy("year", LOAD_COLUMN)
     .parquet(lake))


def ingest_flights(spark: SparkSession, source: str | list[str], lake: str,
                   header: bool = True, mode: str = "overwrite",
                   max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
                   sort_within: tuple[str, ...] = ("month", "day_of_month")) -> None:
    """Raw flight files -> typed lake, in one job.

    With ``mode="overwrite"`` the rows that the same files gave before are
    replaced; readers see the old rows until the new ones are all there."""
    if is_stream_lake(spark, lake):
        raise ValueError(f"{lake} is written by a stream; load into a folder of its own and read both")
    paths = [source] if isinstance(source, str) else list(source)
    text = spark.read.text(paths)
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    lines = text.select("value", F.concat(load_key(F.input_file_name()), F.lit(RUN_MARK + run)).alias(LOAD_COLUMN))
    typed = type_flights(parse_flight_lines(lines, header=header, keep=(LOAD_COLUMN,)), keep=(LOAD_COLUMN,))
    if mode != "overwrite":
        write_flights_lake(typed, lake, mode, max_records_per_file, sort_within)
        return
    files = text.inputFiles()
    if not files:
        return
    keys = [r[0] for r in spark.createDataFrame([(f,) for f in files], "path string").select(load_key(F.col("path"))).collect()]
    journal = Journal(spark, lake)
    journal.begin(run, keys)
    write_flights_lake(typed, lake, "append", max_records_per_file, sort_within)
    try:
        journal.commit(run)
    except RuntimeError:  # another run of the same files has overtaken this one
        journal.drop_run(run)
        raise
    journal.clean(run)
