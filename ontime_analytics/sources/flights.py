"""Flight records -> raw STRING DataFrame -> typed ``flights`` DataFrame.

The raw layer mirrors the text files: each line is split on ``,`` into 29
positional STRING columns - no quoting, an empty field stays ``''`` (a value
of its own, e.g. the empty cancellation code) and a field missing from a short
row is NULL.  Typing (P1/P3) happens once, in
:func:`type_flights`; the typed table is what every query reads, normally from
the Parquet lake written by :mod:`ontime_analytics.sources.ingest`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ontime_analytics import schema as S
from ontime_analytics.functions.parse import strict_int
from ontime_analytics.sources.loads import Journal

FIELD_COUNT_COLUMN, FIELDS_COLUMN = "_fields", "_split"
LOAD_COLUMN = "load"


def parse_flight_lines(lines: DataFrame, header: bool = False, value: str = "value",
                       keep_field_count: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Split text lines on ``,`` into the 29 raw STRING columns by position.

    No quoting (as in the files); an empty field is ``''``; a short line gives
    NULL for the missing fields.  With ``header`` the header lines (first field
    ``Year``) are dropped - one per input file, wherever Spark split them."""
    if header:
        lines = lines.filter(~F.col(value).startswith(S.RAW_COLUMNS[0] + ","))
    # a projection of its own, so that a line is split once and not for every column
    split = lines.select(F.split(F.col(value), ",", -1).alias(FIELDS_COLUMN), *keep)
    cols = [F.try_element_at(FIELDS_COLUMN, F.lit(i + 1)).alias(c) for i, c in enumerate(S.RAW_COLUMNS)]
    if keep_field_count:
        cols.append(F.size(FIELDS_COLUMN).alias(FIELD_COUNT_COLUMN))
    return split.select(*cols, *keep)


def read_flights_raw(spark: SparkSession, path: str | list[str], header: bool = False,
                     keep_field_count: bool = False) -> DataFrame:
    """Read flight files (plain or compressed, e.g. ``*.csv.bz2``, which Hadoop
    splits across tasks) as 29 STRING columns."""
    paths = [path] if isinstance(path, str) else list(path)
    return parse_flight_lines(spark.read.text(paths), header=header,
                              keep_field_count=keep_field_count)


def type_flights(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project and type the 18 used raw columns (plus the upper-cased
    cancellation code), and the columns named in ``keep`` as they are.  Works on
    any DataFrame that has the raw column names."""
    ints = {typed: strict_int(name).alias(typed) for name, typed in S.INT_FIELDS}
    ints["year"] = strict_int("Year").alias("year", metadata={S.PARSED_HERE: True})
    strs = {typed: F.col(name).alias(typed) for name, typed in S.STRING_FIELDS}
    code = F.col("CancellationCode")
    extra = {
        "tail_num": F.trim(F.col("TailNum")).alias("tail_num"),
        "cancelled": strict_int("Cancelled", default=0).alias("cancelled"),
        "cancel_code_raw": F.coalesce(code, F.lit("")).alias("cancel_code_raw"),
        "cancel_code": F.upper(code).alias("cancel_code"),
    }
    by_name = {**ints, **strs, **extra}
    return raw.select(*[by_name[c] for c in S.FLIGHT_COLUMNS], *keep)


def read_flights(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read typed flights from one lake or several (Parquet, partitioned by
    ``year`` and ``load``), e.g. one of batch loads and one of a stream.

    The schema is fixed: no footer is read for it, an empty lake gives no rows
    and a lake with NULL years only keeps its column types.  Loads that the
    lake's journal says do not count (:mod:`.loads`) are pruned as partitions;
    a lake at rest has none."""
    paths = [path] if isinstance(path, str) else list(path)
    return reduce(DataFrame.unionByName, [_read_lake(spark, p) for p in paths])


def _read_lake(spark: SparkSession, path: str) -> DataFrame:
    schema = StructType([*S.FLIGHTS_SCHEMA.fields, StructField(LOAD_COLUMN, StringType())])
    lake = spark.read.schema(schema).parquet(path)
    journal = Journal(spark, path)
    void = journal.void(journal.partitions()) if journal.notes() else set()
    if void:
        lake = lake.filter(F.col(LOAD_COLUMN).isNull() | ~F.col(LOAD_COLUMN).isin(*sorted(void)))
    return lake.select(*S.FLIGHT_COLUMNS)


def read_flights_csv(spark: SparkSession, path: str | list[str], header: bool = False) -> DataFrame:
    """Typed flights straight from CSV (no lake in between)."""
    return type_flights(read_flights_raw(spark, path, header=header))


def bad_line_counts(lines: DataFrame, header: bool = False) -> DataFrame:
    """Malformed-input report for flight lines (column ``value``), in one pass (one
    global aggregate): rows, rows with a field count other than 29, and for
    every integer field the values that are neither a strict integer nor the
    ``NA`` marker (``unparsable_<column>``; a missing field counts)."""
    raw = parse_flight_lines(lines, header=header, keep_field_count=True)

    def unparsable(name: str):
        c = F.col(name)
        return F.count_if(strict_int(c).isNull() & ~F.coalesce(c == "NA", F.lit(False)))

    return raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(FIELD_COUNT_COLUMN) != len(S.RAW_COLUMNS)).alias("wrong_field_count"),
        *[unparsable(name).alias(f"unparsable_{typed}") for name, typed in S.INT_FIELDS],
    )


def bad_rows(spark: SparkSession, path: str | list[str], header: bool = False) -> DataFrame:
    """:func:`bad_line_counts` of a set of flight files."""
    return bad_line_counts(spark.read.text([path] if isinstance(path, str) else list(path)), header)
