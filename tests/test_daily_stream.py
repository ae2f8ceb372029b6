"""Streaming aggregates: closed days, restart, late rows, lines delivered twice; and the two registered queries."""

from __future__ import annotations

import os
import re

import pytest
from oracle_check import compare
from table_dirs import SF01

import __spark_entry__ as E
from ontime_analytics.sources import read_flights_csv
from ontime_analytics.streaming import daily


def line(y, m, d, delay, cancelled=0, tail="N1", n=1):
    f = [""] * 29
    f[0], f[1], f[2], f[3], f[8], f[9], f[10], f[14], f[15], f[16], f[18], f[21] = map(str, (y, m, d, 1, "AA", n, tail, 0, delay, "ORD", 100, cancelled))
    return ",".join(f)


def put(folder, name, lines, second=None):
    """A file; ``second`` sets when it came, as a stream takes the oldest first."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    if second is not None:
        os.utime(folder / name, (1_700_000_000 + second, 1_700_000_000 + second))


def run(spark, tmp_path, **more):
    q = daily.start_daily_delays(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), header=False, **more)
    q.awaitTermination()
    assert q.exception() is None
    return {str(r["day"]): (r["day_of_week"], r["flights"], r["delayed_flights"], r["cancelled_flights"], r["delay_minutes"])
            for r in spark.read.parquet(str(tmp_path / "out")).collect()}


@pytest.mark.parametrize("name", sorted(daily.STREAM_QUERIES))
def test_stream_query_matches_oracle(spark, duck01, name):
    ok, msg = compare(spark, duck01, name, SF01)
    assert ok, f"{name}: {msg}"
    assert name in E.queries() and name in E.oracle_sql()


def test_days_close_once_and_state_survives_a_restart(spark, tmp_path):
    put(tmp_path / "in", "a.csv", [line(1999, 3, 1, 20), line(1999, 3, 1, 5, cancelled=1), line(1999, 3, 6, 30), line("NA", 1, 1, 9), "x"])
    assert run(spark, tmp_path, late_after="3 days") == {"1999-03-01": (1, 2, 1, 1, 20)}  # 6 March less three days
    put(tmp_path / "in", "b.csv", [line(1999, 3, 6, 40), line(1999, 3, 5, 16), line(1999, 3, 12, 1)])
    got = run(spark, tmp_path, late_after="3 days")
    assert got == {"1999-03-01": (1, 2, 1, 1, 20), "1999-03-05": (5, 1, 1, 0, 16), "1999-03-06": (6, 2, 2, 0, 70)}  # the state of 6 March came along
    assert run(spark, tmp_path, late_after="3 days") == got  # nothing new, nothing twice


def test_late_rows_are_counted_apart(spark, tmp_path):
    put(tmp_path / "in", "a.csv", [line(1999, 3, 1, 20), line(1999, 3, 10, 30)])
    first = run(spark, tmp_path, late_after="2 days")
    put(tmp_path / "in", "b.csv", [line(1999, 3, 1, 50), line(1999, 3, 2, 1), line(1999, 3, 9, 2), line(1999, 3, 20, 3)])
    got = run(spark, tmp_path, late_after="2 days")
    assert got["1999-03-01"] == first["1999-03-01"] == (1, 1, 1, 0, 20) and "1999-03-02" not in got  # both days were closed
    assert got["1999-03-09"][1] == 1  # this one was still open
    lake = read_flights_csv(spark, str(tmp_path / "in"))
    late = daily.late_flights(lake, spark.read.parquet(str(tmp_path / "out")))
    assert {str(r["day"]): r["late_flights"] for r in late.collect()} == {"1999-03-01": 1, "1999-03-02": 1}


def test_several_batches_give_the_same_closed_days(spark, tmp_path):
    for k in range(4):
        put(tmp_path / "in", f"{k}.csv", [line(1999, 1, 1 + 5 * k + i % 5, 10 * i) for i in range(20)], second=60 * k)
    got = run(spark, tmp_path, late_after="5 days", max_files_per_trigger=1)
    assert all(v[1] == 4 for v in got.values()) and sorted(got) == [f"1999-01-{d:02d}" for d in range(1, 15)]


def test_batch_of_all_days(spark, tmp_path):
    put(tmp_path / "in", "a.csv", [line(1999, 3, 1, 20), line(2001, 3, 10, 30)])
    assert daily.daily_delays(read_flights_csv(spark, str(tmp_path / "in"))).count() == 2


def test_lines_delivered_twice_count_once(spark, tmp_path):
    rows = [line(1999, 3, d, 5, n=d) for d in range(1, 11)]
    put(tmp_path / "in", "a.csv", [*rows, rows[0], "no date,1", "no date,1"])
    stream = daily.drop_repeated_lines(spark.readStream.text(str(tmp_path / "in")), late_after="30 days")
    go = lambda: daily._started(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    go()
    put(tmp_path / "in", "b.csv", [*rows[3:], line(1999, 3, 11, 5)])
    go()  # a new run knows what the first one delivered
    got = sorted(r["value"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted([*rows, line(1999, 3, 11, 5), "no date,1", "no date,1"])


def test_a_line_is_built_once_a_branch(spark, monkeypatch):
    """What builds a line, and splits it, stands once in either branch of the plan: no filter repeats it."""
    from ontime_analytics.sources.fixture import dealt_evenly, flight_lines_from_lineitem

    table = dealt_evenly(spark.read.parquet(f"{SF01}/lineitem.parquet"))
    assert table.rdd.getNumPartitions() % spark.sparkContext.defaultParallelism == 0
    lines = flight_lines_from_lineitem(table)
    monkeypatch.setattr(type(lines), "dropDuplicatesWithinWatermark", lambda df, keys: df.dropDuplicates(keys))  # a batch has a plan without a run
    plan = daily.drop_repeated_lines(lines)._jdf.queryExecution().optimizedPlan().toString()
    built = lines._jdf.queryExecution().optimizedPlan().toString().count("concat_ws(")
    assert built == 3 and plan.count("concat_ws(") == 2 * built and plan.count("split(") == 2


def test_dates_at_the_head_of_odd_lines(spark, tmp_path):
    """Lines of which only the first fields are there, or more than 29; what is no date is kept each time."""
    undated = ["", ",,", "1999", "1999,1", "1999,,3", "1999,2,30", " 1999,1,3", "1999,1,3 ,x", "1999.0,1,3", "99999999999,1,3", "x,1999,1,3"]
    dated = ["1999,1,3", "+1999,01,3,", "1999,1,3,x", "1999,1,4" + ",x" * 40, "1999,12,31," + "," * 25]
    for name in ("a.csv", "b.csv"):
        put(tmp_path / "in", name, [*undated, *dated])
    lines = spark.readStream.text(str(tmp_path / "in")).selectExpr("value as line", "1 as source")
    stream = daily.drop_repeated_lines(lines, value="line")
    assert stream.columns == ["line", "source"]
    daily._started(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    count = {r["line"]: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("line").count().collect()}
    assert count == {**dict.fromkeys(undated, 2), **dict.fromkeys(dated, 1)}


def test_keys_expire_with_the_watermark(spark, tmp_path):
    """State does not grow with the input: a key goes when its day is past the watermark."""
    old = [line(1999, 1, 1, 5, n=k) for k in range(50)]
    put(tmp_path / "in", "a.csv", old)
    stream = daily.drop_repeated_lines(spark.readStream.text(str(tmp_path / "in")), late_after="2 days")

    def rows_in_state():
        q = daily._started(stream, str(tmp_path / "out"), str(tmp_path / "state"))
        q.awaitTermination()
        return q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]

    assert rows_in_state() == 50
    put(tmp_path / "in", "b.csv", [line(1999, 6, 1, 5)])
    assert rows_in_state() == 1


def test_stream_plan_has_one_state_store(spark, tmp_path):
    put(tmp_path / "in", "a.csv", [line(1999, 3, 1, 20)])
    q = daily.start_daily_delays(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), header=False)
    q.awaitTermination()
    plan = q._jsq.explainInternal(False)
    assert len(re.findall(r"StateStoreSave", plan)) == 1 and "partial_count" in plan and "Python" not in plan
