"""Lossless loads: batch and stream, several lakes, odd inputs, the daylight-saving rule from 2007."""

from __future__ import annotations

import json

import pytest
from test_io import HEADER, ROWS_1987, ROWS_2008, write_text

from ontime_analytics import schema as S
from ontime_analytics.jobs import JOBS, main, parse_params, run_job
from ontime_analytics.operators import dst
from ontime_analytics.sources import ingest_flights, read_flights
from ontime_analytics.streaming import start_flight_ingest
from ontime_analytics.streaming.ingest import default_checkpoint


def line(**fields) -> str:
    base = {"Year": "2008", "Month": "1", "DayofMonth": "5", "DayOfWeek": "6", "UniqueCarrier": "AA", "TailNum": "N1", "ArrDelay": "5",
            "DepDelay": "20", "Origin": "SAN", "Distance": "447", "Cancelled": "0"}
    return ",".join({**base, **fields}.get(c, "") for c in S.RAW_COLUMNS)


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def months(spark, *lakes):
    return sorted((r.year if r.year is not None else 0, r.month, r["count"]) for r in
                  read_flights(spark, list(map(str, lakes))).groupBy("year", "month").count().collect())


def test_two_loads_of_one_year_keep_both(spark, tmp_path):
    lake = str(tmp_path / "lake")
    jan = put(tmp_path / "a" / "2008-01.csv", *[line()] * 3)
    ingest_flights(spark, jan, lake)
    ingest_flights(spark, put(tmp_path / "a" / "2008-02.csv", *[line(Month="2")] * 2), lake)
    assert months(spark, lake) == [(2008, 1, 3), (2008, 2, 2)]
    # the same file name in another folder is another load
    ingest_flights(spark, put(tmp_path / "b" / "2008-02.csv", line(Month="3")), lake)
    assert months(spark, lake) == [(2008, 1, 3), (2008, 2, 2), (2008, 3, 1)]
    # a file loaded again replaces what it gave, also in a year that it no longer has
    put(tmp_path / "a" / "2008-01.csv", line(Year="2007", Month="12"))
    ingest_flights(spark, jan, lake)
    assert months(spark, lake) == [(2007, 12, 1), (2008, 2, 2), (2008, 3, 1)]


def test_rows_without_a_year_stay_with_their_load(spark, tmp_path):
    lake = str(tmp_path / "lake")
    ingest_flights(spark, put(tmp_path / "x.csv", *[line(Year="x")] * 3, line()), lake)
    ingest_flights(spark, put(tmp_path / "y.csv", *[line(Year="")] * 2, line()), lake)
    assert months(spark, lake) == [(0, 1, 5), (2008, 1, 2)]
    assert read_flights(spark, lake).schema["year"].dataType == S.FLIGHTS_SCHEMA["year"].dataType


def test_file_names_with_special_characters(spark, tmp_path):
    lake = str(tmp_path / "lake")
    odd = put(tmp_path / "s" / "a=b [1] 100%.csv", line())
    for _ in range(2):
        ingest_flights(spark, str(tmp_path / "s"), lake)
    assert odd and months(spark, lake) == [(2008, 1, 1)]


def test_batch_and_stream_do_not_hide_each_other(spark, tmp_path):
    batch, stream = tmp_path / "batch", tmp_path / "stream"
    src = put(tmp_path / "old" / "2007.csv", *[line(Year="2007")] * 4)
    ingest_flights(spark, src, str(batch))
    put(tmp_path / "new" / "2008.csv", *[line()] * 3)

    def run(lake, name):
        start_flight_ingest(spark, str(tmp_path / "new"), str(lake), checkpoint_location=str(tmp_path / name)).awaitTermination(120)

    with pytest.raises(ValueError, match="batch loads"):
        run(batch, "c0")
    run(stream, "c1")
    with pytest.raises(ValueError, match="stream"):
        ingest_flights(spark, src, str(stream))
    assert months(spark, batch, stream) == [(2007, 1, 4), (2008, 1, 3)]
    # one source into a second lake, with a checkpoint of its own
    run(tmp_path / "second", "c2")
    assert months(spark, tmp_path / "second") == [(2008, 1, 3)]


def test_default_checkpoint_follows_source_and_lake(spark, monkeypatch):
    from ontime_analytics.streaming import ingest

    monkeypatch.setattr(ingest, "has_shared_folder", lambda s: True)
    a = default_checkpoint(spark, "/in", "/lake1")
    assert a == default_checkpoint(spark, "/in/", "/lake1") != default_checkpoint(spark, "/in", "/lake2")
    monkeypatch.setattr(ingest, "has_shared_folder", lambda s: False)
    with pytest.raises(ValueError, match="checkpoint_location"):
        default_checkpoint(spark, "/in", "/lake1")


@pytest.mark.parametrize("text", ["", "\n"])
@pytest.mark.parametrize("raw", [True, False])
def test_empty_files_in_every_job(spark, tmp_path, text, raw):
    src, lake = tmp_path / "src", tmp_path / "lake"
    src.mkdir()
    (src / "2008.csv").write_text(text)
    if not raw:
        ingest_flights(spark, str(src), str(lake), header=False)
    for job in ("airports", "cancellations", "flight-delays", "dst", "distance"):
        names = run_job(spark, job, str(src if raw else lake), str(tmp_path / "out" / job), raw=raw)
        assert names == list(JOBS[job])
    got = [json.loads(x) for p in (tmp_path / "out" / "flight-delays" / "delay_by_year" / "json").glob("part-*") for x in p.read_text().splitlines()]
    assert got == ([{"year": None, "delay_minutes": 0, "flights": 1}] if text else [])  # NULL keys are written


def dst_rows():
    days = [(2006, 4, 2), (2006, 10, 29), (2007, 3, 11), (2007, 4, 1), (2007, 11, 4), (2008, 3, 9), (2008, 3, 30), (2015, 3, 8), (2015, 11, 1),
            (2015, 11, 8), (1986, 4, 6), (2015, 10, 25)]
    return [line(Year=str(y), Month=str(m), DayofMonth=str(d), DepDelay=str(16 + i)) for i, (y, m, d) in enumerate(days)]


def test_daylight_saving_rule_on_a_lake(spark, tmp_path):
    lake = str(tmp_path / "lake")
    ingest_flights(spark, put(tmp_path / "all.csv", *dst_rows()), lake)
    flights = read_flights(spark, lake)
    want = {2006: 16.5, 2007: 19.0, 2008: 21.0, 2015: 23.5}
    assert {r.year: r.avg_delay for r in dst.dst_average_delay(flights).collect()} == want
    assert {r.year for r in dst.dst_average_delay(flights, last_year=2008).collect()} == {2006, 2007, 2008}
    for job in ("dst", "all"):
        out = tmp_path / job
        assert main([job, "--flights", lake, "--out", str(out), "--param", "dst_average_delay.last_year=2014",
                     "--param", "dst_delay_percent.first_year=1980"]) == 0
        read = lambda n: {json.loads(x)["year"] for p in (out / n / "json").glob("part-*") for x in p.read_text().splitlines()}
        assert read("dst_average_delay") == {2006, 2007, 2008}
        assert read("dst_delay_percent") == {1986, 2006, 2007, 2008, 2015}


def test_params_are_checked_up_front():
    assert parse_params(["dst_average_delay.last_year=2015"]) == {"dst_average_delay": {"last_year": 2015}}
    for bad in ("dst_average_delay.lastyear=2015", "delay_by_year.k=3", "model_count_top.join=x"):
        with pytest.raises(SystemExit):
            parse_params([bad])


def test_commands(spark, tmp_path):
    src = put(tmp_path / "in" / "1987.csv", *ROWS_1987, "x,y")
    write_text(tmp_path / "in" / "2008.csv", ROWS_2008, header=True)
    out = tmp_path / "out"
    assert main(["bad-rows", "--flights", src, "--out", str(out), "--header"]) == 0
    report = json.loads("".join(p.read_text() for p in (out / "bad_rows").glob("part-*")))
    assert report["rows"] == len(ROWS_1987) + 1 and report["wrong_field_count"] >= 1
    lake = tmp_path / "lake"
    for _ in range(2):
        assert main(["stream-ingest", "--flights", str(tmp_path / "in"), "--out", str(lake), "--header",
                     "--checkpoint", str(tmp_path / "c"), "--max-files", "1"]) == 0
    assert read_flights(spark, str(lake)).count() == len(ROWS_1987) + 1 + len(ROWS_2008)
    with pytest.raises(SystemExit):
        main(["airports", "--out", str(out)])


def test_staged_tables_are_removed(spark, tmp_path):
    import os

    from ontime_analytics.session import checkpoint_dir

    folder = checkpoint_dir(spark)
    staged = lambda: {x for x in os.listdir(folder) if x.startswith(("staged-flights", "summary-", "aircraft-"))}
    before = staged()
    src = put(tmp_path / "in" / "1987.csv", *ROWS_1987)
    run_job(spark, "cancellations", src, str(tmp_path / "out"), raw=True, header=True)
    assert staged() == before
    (tmp_path / "blocked").write_text("a file where the job wants a folder")
    with pytest.raises(Exception):
        run_job(spark, "cancellations", src, str(tmp_path / "blocked"), raw=True, header=True)
    assert staged() == before
