"""Loads that replace a file's rows in one step; results stored and read back; one parse a field, one split a line."""

from __future__ import annotations

import datetime
import re

import pytest
from oracle_check import compare
from pyspark.sql import functions as F
from table_dirs import SF01
from test_lake import line, months, put
from test_plans import plan

import __spark_entry__ as E
from ontime_analytics import schema as S
from ontime_analytics.functions.calendar import filter_dst_days, is_dst_crossover
from ontime_analytics.functions.parse import strict_int
from ontime_analytics.plans.stored import STORED_QUERIES
from ontime_analytics.sources import ingest, ingest_flights, loads, read_flights
from ontime_analytics.sources.flights import type_flights
from ontime_analytics.sources.loads import Journal, void_loads


@pytest.mark.parametrize("name", sorted(STORED_QUERIES))
def test_stored_query_matches_oracle(spark, duck01, name):
    ok, msg = compare(spark, duck01, name, SF01)
    assert ok, f"{name}: {msg}"
    assert name in E.queries() and name in E.oracle_sql()


# ---- the journal

def broken_at(monkeypatch, what):
    def fail(*a, **b):
        raise RuntimeError("lost")
    monkeypatch.setattr(*what, fail)


STEPS = {"before the write": (ingest, "write_flights_lake"), "after the write": (Journal, "commit"), "after the commit": (Journal, "clean")}


@pytest.mark.parametrize("step", sorted(STEPS))
def test_a_load_that_breaks_off_counts_wholly_or_not(spark, tmp_path, monkeypatch, step):
    lake = str(tmp_path / "lake")
    src = put(tmp_path / "a" / "x.csv", *[line()] * 3, line(Year="2007"))
    other = put(tmp_path / "a" / "y.csv", *[line(Month="5")] * 2)
    ingest_flights(spark, [src, other], lake)
    old = [(2007, 1, 1), (2008, 1, 3), (2008, 5, 2)]
    assert months(spark, lake) == old
    put(tmp_path / "a" / "x.csv", *[line(Month="2")] * 4)
    new = [(2008, 2, 4), (2008, 5, 2)]
    with monkeypatch.context() as m:
        broken_at(m, STEPS[step])
        if step == "after the write":
            m.setattr(Journal, "drop_run", lambda *a: None)  # the driver is gone: nobody clears up
        with pytest.raises(RuntimeError):
            ingest_flights(spark, src, lake)
    assert months(spark, lake) == (new if step == "after the commit" else old)
    ingest_flights(spark, src, lake)  # again, with what the broken run has left
    assert months(spark, lake) == new
    journal = Journal(spark, lake)
    assert journal.notes() == [] and len(journal.partitions()) == 2
    assert "load" not in plan(read_flights(spark, lake).select("month")).split("PartitionFilters")[1].split("]")[0]


def test_a_lake_with_open_notes_is_pruned_by_partition(spark, tmp_path, monkeypatch):
    lake = str(tmp_path / "lake")
    src = put(tmp_path / "x.csv", line())
    ingest_flights(spark, src, lake)
    with monkeypatch.context() as m:
        broken_at(m, (Journal, "clean"))
        with pytest.raises(RuntimeError):
            ingest_flights(spark, src, lake)
    df = read_flights(spark, lake)
    assert df.count() == 1 and re.search(r"PartitionFilters: \[[^\]]*load", plan(df))


def test_overtaken_run_takes_its_rows_back(spark, tmp_path, monkeypatch):
    lake = str(tmp_path / "lake")
    src = put(tmp_path / "x.csv", *[line()] * 2)
    commit = Journal.commit

    def overtaken(self, run):
        with monkeypatch.context() as m:
            m.setattr(Journal, "commit", commit)
            ingest_flights(spark, src, lake)  # a second run of the same file begins later and ends before
        commit(self, run)

    with monkeypatch.context() as m:
        m.setattr(Journal, "commit", overtaken)
        with pytest.raises(Exception):
            ingest_flights(spark, src, lake)
    assert months(spark, lake) == [(2008, 1, 2)]


def test_loads_without_a_run_are_replaced_too(spark, tmp_path):
    """Lakes of plain loads (another writer, or an earlier version) go on."""
    lake = str(tmp_path / "lake")
    src = put(tmp_path / "x.csv", line())
    key = spark.createDataFrame([("file:" + src,)], "p string").select(ingest.load_key(F.col("p"))).first()[0]
    names = [r[0] for r in spark.createDataFrame([(f,) for f in spark.read.text(src).inputFiles()], "p string").select(ingest.load_key(F.col("p"))).collect()]
    assert key.split("~")[0] == names[0].split("~")[0]
    ingest.write_flights_lake(type_flights(spark.createDataFrame([tuple("1" for _ in S.RAW_COLUMNS)], ", ".join(f"{c} string" for c in S.RAW_COLUMNS))), lake, load=names[0])
    assert months(spark, lake) == [(1, 1, 1)]
    ingest_flights(spark, src, lake)
    assert months(spark, lake) == [(2008, 1, 1)]


def test_void_loads():
    notes = [("1", "done", {"a"}), ("2", "intent", {"a", "b"}), ("3", "done", {"b"})]
    there = ["a", "a@0", "a@1", "a@2", "a@9", "b@2", "b@3", "b@1", "c", "c@1", "d~x"]
    assert void_loads(notes, there) == {"a", "a@0", "a@2", "b@2", "b@1"}
    assert loads.key_of("x~1@7") == "x~1" and loads.key_of("x~1") == "x~1"


def one_row_group(spark, folder, n=4000):
    """A ``lineitem`` table that one task has to read."""
    rows = spark.range(n).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 200).alias("l_partkey"), (F.col("id") % 10).alias("l_suppkey"), (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        (F.col("id") % 50).cast("double").alias("l_quantity"), F.lit(1800.0).alias("l_extendedprice"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.timestamp_seconds(F.lit(800_000_000) + F.col("id") * 86_400 % 200_000_000).alias("l_shipdate"))
    rows.coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_raw_lines_are_written_and_read_by_all_cores(spark, tmp_path, monkeypatch):
    """Bzip2 is the query's cost: a table of one row group must not be compressed, nor loaded, by one task."""
    from ontime_analytics.plans import stored

    monkeypatch.setattr(stored, "_folder", lambda s, name: str(tmp_path / name))
    sf, cores = one_row_group(spark, tmp_path), spark.sparkContext.defaultParallelism
    got = stored.ingested_lake_totals(spark, sf).collect()
    assert sum(r["flights"] for r in got) == 4000
    sizes = [p.stat().st_size for p in (tmp_path / "raw-lines").glob("part-*.bz2")]
    assert len(sizes) == cores and max(sizes) < 2 * min(sizes)
    assert spark.read.text(str(tmp_path / "raw-lines")).rdd.getNumPartitions() == cores


@pytest.mark.parametrize("path", ["file:/a/b c.csv", "file:/a/2008.csv.bz2", "s3a://x/=%5B1%5D~@.csv", "name", "/ends/", ""])
def test_load_keys_stay_what_they_were(spark, path):
    df = spark.createDataFrame([(path,)], "p string")
    was = F.concat(F.regexp_extract("p", r"([^/]*)$", 1), F.lit("~"), F.lower(F.hex(F.xxhash64("p"))))
    row = df.select(ingest.load_key(F.col("p")), was).first()
    assert row[0] == row[1] and "regexp" not in str(ingest.load_key(F.col("p")))


# ---- parsing

def test_strict_integers(spark):
    good = {"0": 0, "-7": -7, "+5": 5, "007": 7, "2147483647": 2147483647}
    bad = ["", " ", " 20", "20 ", "\t3", "\x7f3", "3\x7f", "5.7", "5.", "1e3", "NA", "+", "-", "--1", "2147483648", "٣", "é1", "1é", "1\x85", "1 2", "0x1", "1L", None, "!", "~"]
    df = spark.createDataFrame([(x,) for x in [*good, *bad]], "s string").select("s", strict_int("s").alias("n"))
    assert {r["s"]: r["n"] for r in df.collect()} == {**good, **dict.fromkeys(bad)}


def test_a_line_is_split_once(spark):
    for name in ("parsed_line_totals", "bad_rows"):
        p = E.queries()[name](spark, SF01)._jdf.queryExecution().optimizedPlan().toString()
        assert p.count("split(") == 1, name


def test_parsed_fields_are_named_once_before_the_daylight_filter(spark):
    """The three numbers are parsed in a generator below the filter, once each."""
    p = E.queries()["dst_delay_percent"](spark, SF01)._jdf.queryExecution().optimizedPlan().toString()
    above, below = p.split("Generate inline")
    where = next(x for x in above.splitlines() if "next_day" in x)
    assert "Filter" in where and "RLIKE" not in above
    assert below.splitlines()[0].count("RLIKE") <= 4


def test_daylight_days_of_parsed_and_typed_rows(spark):
    """All days of 1985 to 2012, and no dates at all: the same days by date as by the three numbers."""
    first = datetime.date(1985, 1, 1)
    days = [first + datetime.timedelta(k) for k in range(28 * 366)]
    raw = [(str(d.year), str(d.month), str(d.day)) for d in days] + [("2001", "2", "30"), ("NA", "4", "1"), ("0", "4", "3"), ("10000", "4", "2"), ("9999", "4", "4"), (" 1999", "4", "4"), ("1999", "", "4")]
    text = spark.createDataFrame(raw, "Year string, Month string, DayofMonth string")
    for c in S.RAW_COLUMNS:
        if c not in text.columns:
            text = text.withColumn(c, F.lit("0"))
    parsed = type_flights(text).select("year", "month", "day_of_month")
    typed = spark.createDataFrame(parsed.collect(), "year int, month int, day_of_month int")
    assert S.PARSED_HERE in parsed.schema["year"].metadata and S.PARSED_HERE not in typed.schema["year"].metadata
    for years in ({}, {"first_year": 1990, "last_year": 2009}, {"first_year": None}):
        want = {tuple(r) for r in typed.filter(is_dst_crossover(**years)).collect()}
        assert {tuple(r) for r in filter_dst_days(parsed, **years).collect()} == want == {tuple(r) for r in filter_dst_days(typed, **years).collect()}
        assert len(want) > 30
