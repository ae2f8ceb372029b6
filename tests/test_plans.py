"""Physical-plan properties: pruning, one scan, broadcast where checked,
co-partitioned fallback join, top-k without a global sort, no Python."""

from __future__ import annotations

import re

import pytest
from table_dirs import SF01

import __spark_entry__ as E
from ontime_analytics.operators import models
from ontime_analytics.operators.aircraft import ModelJoin
from ontime_analytics.plans.catalog import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


def formatted(df) -> str:
    """The text of ``df.explain("formatted")`` (one attribute per line)."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def q():
    return {n: f for n, f in E.queries().items() if n in QUERIES}


def test_no_python_in_any_plan(spark, q):
    for name, fn in q.items():
        p = plan(fn(spark, SF01))
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas", p), name


@pytest.mark.parametrize("name", ["delay_by_year", "cancellations_by_carrier", "distance_impact",
                                  "cancellations_by_reason", "delay_reason_minutes",
                                  "monthly_airlines_delays", "dst_average_delay"])
def test_single_scan_of_the_fact_table(spark, q, name):
    p = plan(q[name](spark, SF01))
    assert p.count("lineitem.parquet") == 1, name


def test_scan_reads_only_needed_columns(spark, q):
    p = plan(q["delays_by_day_of_week"](spark, SF01))
    scanned = re.search(r"FileScan parquet \[([^\]]*)\]", p).group(1)
    cols = {c.split("#")[0] for c in scanned.split(",")}
    assert cols == {"l_partkey", "l_linenumber", "l_quantity", "l_linestatus", "l_shipdate"}


@pytest.mark.parametrize("name", ["model_delay_count", "model_average_delay", "model_delay_percent",
                                  "flights_delays_by_model", "delays_by_model_all"])
def test_model_queries_broadcast_the_checked_dimension(spark, q, name):
    p = final_plan(q[name](spark, SF01))
    assert "BroadcastHashJoin" in p and "BuildRight" in p, name
    # the flights are never shuffled on the tail
    assert not re.search(r"Exchange hashpartitioning\(tail", p.split("BroadcastExchange")[0])


def test_shuffle_fallback_is_co_partitioned(spark, flights01, aircraft01):
    df = models.flights_delays_by_model(flights01, aircraft01, ModelJoin(strategy="shuffle"))
    p = plan(df)
    assert "SortMergeJoin" in p and "BroadcastHashJoin [tail" not in p
    # one exchange on the tail per side (the two aggregations) and none added for the join
    assert len(re.findall(r"Exchange hashpartitioning\(tail#\d+, ", p)) == 2
    # per-tail pre-aggregation below the join
    assert re.search(r"SortMergeJoin.*?HashAggregate\(keys=\[tail", p, re.S)


def test_dst_needs_no_join(spark, q):
    assert "Join" not in final_plan(q["dst_delay_percent"](spark, SF01))


@pytest.mark.parametrize("name", ["airport_count_top", "airport_percent_bottom",
                                  "model_count_top", "model_average_top"])
def test_top_k_is_take_ordered(spark, q, name):
    p = plan(q[name](spark, SF01))
    assert "TakeOrderedAndProject" in p and "Sort [" not in p.split("TakeOrderedAndProject")[0]


def test_partial_aggregation_before_every_shuffle(spark, q):
    p = plan(q["airport_delay_count"](spark, SF01))
    assert "partial_count" in p


def test_whole_stage_codegen(spark, q):
    """Both sides of the shuffle run inside whole-stage codegen (``*(n)``):
    the scan-side project + partial aggregate, and the final aggregate."""
    p = final_plan(q["airport_average_delay"](spark, SF01)).split("== Initial Plan ==")[0]
    assert re.search(r"\*\(1\) HashAggregate\(keys=\[origin#\d+\], functions=\[partial_count", p)
    assert re.search(r"\*\(2\) HashAggregate\(keys=\[origin#\d+\], functions=\[count", p)
    assert re.search(r"\*\(1\) Project", p)


def test_lake_scan_prunes_years_and_pushes_days(spark, tmp_path):
    from ontime_analytics.operators import dst
    from ontime_analytics.sources.fixture import fixture_flights
    from ontime_analytics.sources.flights import read_flights
    from ontime_analytics.sources.ingest import write_flights_lake

    lake = str(tmp_path / "lake")
    write_flights_lake(fixture_flights(spark, "/root/testdata/sf0.001"), lake)
    fl = read_flights(spark, lake)
    df = dst.dst_delay_percent(fl, 1996, 1997)
    df.collect()
    p = formatted(df)
    part = next(line for line in p.splitlines() if line.startswith("PartitionFilters:"))
    assert "isnotnull(year" in part and ">= 1996" in part and "<= 1997" in part
    pushed = next(line for line in p.splitlines() if line.startswith("PushedFilters:"))
    for window in ("EqualTo(month,4),LessThanOrEqual(day_of_month,7)", "EqualTo(month,10),GreaterThanOrEqual(day_of_month,25)",
                   "EqualTo(month,11),LessThanOrEqual(day_of_month,7)"):
        assert window in pushed
    schema = next(line for line in p.splitlines() if line.startswith("ReadSchema:"))
    assert schema == "ReadSchema: struct<month:int,day_of_month:int,dep_delay:int>"
    rows = {r.year for r in df.collect()}
    assert rows <= {1996, 1997}
    # the same answer as on the fixture directly
    direct = dst.dst_delay_percent(fixture_flights(spark, "/root/testdata/sf0.001"), 1996, 1997)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, direct.collect()))
