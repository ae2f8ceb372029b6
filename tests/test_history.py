"""Joins in time, runs, ranks, subtotals, quantiles and set comparisons: against DuckDB, and against plain versions with a
key that holds a third of all rows, ties, NULLs, empty inputs and slices of every width."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from oracle_check import compare
from pyspark.sql import functions as F
from table_dirs import SF01
from test_plans import final_plan, plan

import __spark_entry__ as E
from ontime_analytics import schema as S
from ontime_analytics.operators import asof, coverage, cubes, intervals, quantiles, ranks, routes, sketches, streaks
from ontime_analytics.operators.intervals import IntervalJoin
from ontime_analytics.plans.catalog import ALL_QUERIES, LINE_QUERIES, QUERIES, build
from ontime_analytics.plans.history import HISTORY, SQL

WIDTHS = (1, 7, 32, 10_000)


@pytest.mark.parametrize("name", sorted(HISTORY))
def test_query_matches_oracle(spark, duck01, name):
    ok, msg = compare(spark, duck01, name, SF01)
    assert ok, f"{name}: {msg}"


def test_every_query_is_registered():
    assert set(HISTORY) == set(SQL) and set(ALL_QUERIES) == set(QUERIES) | set(HISTORY)
    assert set(ALL_QUERIES) | set(LINE_QUERIES) <= set(E.queries()) and set(HISTORY) <= set(E.oracle_sql())


def test_empty_flights(spark):
    fl = spark.createDataFrame([], S.FLIGHTS_SCHEMA)
    ac = spark.createDataFrame([("1", "a", "m")], "tail string, mfr_model_code string, model string")
    for name, q in ALL_QUERIES.items():
        if name in HISTORY:
            want = [(coverage.RIGHT_ONLY, 1)] if name == "tail_sets" else []
            assert [tuple(r) for r in build(name, fl, ac).collect()] == want, name


@pytest.mark.parametrize("name", sorted(HISTORY))
def test_no_python_no_single_task(spark, name):
    """No Python, no cross product, and nothing but a global total is moved to one task."""
    p = plan(E.queries()[name](spark, SF01))
    assert not re.search(r"EvalPython|PythonUDF|InPandas|InArrow|CartesianProduct|BroadcastNestedLoopJoin", p)
    for m in re.finditer(r"Exchange SinglePartition.*\n[^\n]*?(\w+)\(", p):
        assert m[1] == "HashAggregate", name
    assert not re.search(r"Window \[.*\], \[[^\]]*\]\s*$(?!)", p)
    for line in p.splitlines():  # every window has a partition
        if re.search(r"\bWindow \[", line):
            assert not re.search(r"windowspecdefinition\([a-z_0-9]+#\d+L? (ASC|DESC)", line), line


# ---- as-of

def rows_of_keys(n, seed, keys=6, times=60):
    """(key, time, value): the first key holds a third of all rows, some keys, times and values are missing."""
    r = random.Random(seed)
    pick = lambda: "hot" if r.random() < 0.34 else r.choice([*"abcdef"[:keys], None])
    return [(pick(), r.choice([None, *range(-times, times)]), r.choice([None, *range(9)])) for _ in range(n)]


def greatest(values):
    return max(values, key=lambda v: tuple((x is not None, x) for x in v))


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("strict", [True, False])
def test_asof_as_plain(spark, width, strict):
    left, right = rows_of_keys(400, 1), rows_of_keys(300, 2)
    ldf = spark.createDataFrame(left, "k string, t long, v long")
    rdf = spark.createDataFrame(right, "k string, at long, w long")
    by = defaultdict(lambda: defaultdict(list))
    for k, t, w in right:
        if k is not None and t is not None:
            by[k][t].append((w,))
    for tolerance in (None, 5):
        want = Counter()
        for k, t, v in left:
            times = [] if k is None or t is None else [x for x in by[k] if x < t or (not strict and x == t)]
            times = [x for x in times if tolerance is None or t - x <= tolerance and x == max(times)]
            best = max(times, default=None)
            want[k, t, v, best, None if best is None else greatest(by[k][best])[0]] += 1
        got = asof.asof_join(ldf, rdf, ["k"], "t", "at", ["w"], strict=strict, tolerance=tolerance, slice_width=width)
        assert got.columns == ["k", "t", "v", "prev_time", "prev_w"]
        assert Counter(map(tuple, got.collect())) == want


@pytest.mark.parametrize("width", WIDTHS)
def test_previous_row_as_plain(spark, width):
    rows = {(k, t): v for k, t, v in rows_of_keys(300, 11)}
    df = spark.createDataFrame([(k, t, v, "x") for (k, t), v in rows.items()], "k string, t long, v long, more string")
    got = asof.with_previous(df, ["k"], "t", ["v"], slice_width=width)
    assert got.columns == ["k", "t", "v", "more", "prev_time", "prev_v"]
    want = Counter()
    for (k, t), v in rows.items():
        before = max((u for q, u in rows if q == k and u is not None and u < t), default=None) if None not in (k, t) else None
        want[k, t, v, "x", before, None if before is None else rows[k, before]] += 1
    assert Counter(map(tuple, got.collect())) == want


@pytest.mark.parametrize("name, scans", [("previous_departure_impact", 1), ("previous_departures", 2), ("carrier_year_tails", 1), ("carrier_running_delay", 1),
                                         ("airport_delay_streaks", 1), ("route_changes", 1), ("airport_rank_by_month", 1), ("holiday_window_delays", 1)])
def test_flights_are_read_once_or_twice(spark, name, scans):
    """What a plan uses twice is one exchange that is reused."""
    p = final_plan(E.queries()[name](spark, SF01)).split("== Initial Plan ==")[0]
    reused = set(re.findall(r"ReusedExchange \[[^\n]*", p))
    assert p.count("lineitem.parquet") == scans, (name, len(reused), p.count("lineitem.parquet"))


def test_asof_of_two_keys_and_values(spark):
    left = spark.createDataFrame([(1, "a", 10), (1, "b", 10), (2, "a", 3)], "x int, y string, t int")
    right = spark.createDataFrame([(1, "a", 8, "p", 1), (1, "a", 8, "p", 2), (1, "a", 9, None, 5), (1, "b", 10, "q", 1), (2, "a", 1, "r", None)], "x int, y string, t int, s string, n int")
    got = asof.asof_join(left, right, ["x", "y"], "t", "t", ["s", "n"])
    assert sorted(map(tuple, got.collect())) == [(1, "a", 10, 9, None, 5), (1, "b", 10, None, None, None), (2, "a", 3, 1, "r", None)]


def test_asof_of_a_hot_key_is_spread(spark):
    """A key with a third of all rows: no task gets more points of it than a slice has times, and no range join is planned."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                    (F.col("id") % 3_000).alias("t"), F.col("id").alias("v"))
    got = asof.asof_join(df, df, ["k"], "t", "t", ["v"])
    assert got.filter("k = 'hot' and prev_time is not null").count() == 10_000 - 10
    p = plan(got)
    assert not re.search(r"NestedLoop|Cartesian", p) and re.search(r"Exchange hashpartitioning\(k#\d+, _slice#\d+L", p)
    points = df.groupBy("k", F.col("t").alias("_time")).agg(F.max(F.struct("v")).alias("_value")).withColumn("_asked", F.lit(True))
    sizes = points.groupBy("k", F.floor(F.col("_time") / 32)).count().agg(F.max("count")).first()[0]
    assert sizes <= 32


# ---- intervals

SMALL, LARGE = IntervalJoin(), IntervalJoin(broadcast_max_bytes=0, salts=5)


@pytest.mark.parametrize("how", [SMALL, LARGE, IntervalJoin(bin_width=1), IntervalJoin(bin_width=1000, broadcast_max_bytes=0)])
def test_point_join_as_plain(spark, how):
    r = random.Random(3)
    points = [(i, "hot" if i % 3 == 0 else r.choice(["a", "b", None]), 5 if i % 3 == 0 else r.choice([None, *range(-50, 50)])) for i in range(300)]
    spans = [(j, r.choice(["hot", "a", "b", None]), a, a + r.randrange(-3, 40)) for j, a in enumerate(r.choices(range(-60, 60), k=50))]
    spans += [(100, "hot", None, 3), (101, "hot", 3, None), (102, "hot", -10 ** 4, 10 ** 4), (102, "hot", -10 ** 4, 10 ** 4)]
    p = spark.createDataFrame(points, "i int, k string, x int")
    s = spark.createDataFrame(spans, "j int, k string, start int, end int")
    inside = lambda x, a, z: None not in (x, a, z) and a <= x <= z
    got = intervals.point_join(p, s.drop("k"), "x", how=how).select("i", "j")
    assert Counter(map(tuple, got.collect())) == Counter((i, j) for i, _, x in points for j, _, a, z in spans if inside(x, a, z))
    keyed = intervals.point_join(p, s, "x", on=["k"], how=how)
    assert Counter(map(tuple, keyed.select("i", "k", "j").collect())) == Counter(
        (i, k, j) for i, k, x in points for j, q, a, z in spans if k is not None and k == q and inside(x, a, z))
    outer = intervals.point_join(p, s, "x", on=["k"], how=how, join_type="left").filter("j is null").select("i")
    matched = {i for i, k, x in points for j, q, a, z in spans if k is not None and k == q and inside(x, a, z)}
    assert sorted(r[0] for r in outer.collect()) == sorted(i for i, _, _ in points if i not in matched)


@pytest.mark.parametrize("how", [SMALL, LARGE, IntervalJoin(bin_width=3)])
def test_overlaps_come_once(spark, how):
    r = random.Random(4)
    make = lambda n, tag: [(f"{tag}{i}", a, a + r.randrange(-2, 30)) for i, a in enumerate(r.choices(range(-40, 40), k=n))]
    a, b = make(60, "a"), make(40, "b") + [("long", -500, 500), ("none", None, 4)]
    got = intervals.overlap_join(spark.createDataFrame(a, "p string, a int, b int"), spark.createDataFrame(b, "q string, c int, d int"), "a", "b", "c", "d", how=how)
    want = Counter((p, q) for p, s, e in a for q, x, y in b if None not in (x, y) and s <= e and x <= y and s <= y and x <= e)
    assert Counter(map(tuple, got.select("p", "q").collect())) == want


def test_interval_sides_are_broadcast_only_when_small(spark):
    p = spark.range(1000).select(F.col("id").alias("x"))
    s = spark.createDataFrame([(1, 5)], "start int, end int")
    assert "BroadcastHashJoin" in final_plan(intervals.point_join(p, s, "x"))
    big = final_plan(intervals.point_join(p, s, "x", how=LARGE))
    assert "SortMergeJoin" in big and "Broadcast" not in big and "_salt" in big


def test_windows_of_the_year(spark):
    fl = spark.createDataFrame([(1999,), (2001,), (None,)], "year int")
    got = {(r["window"], r["window_year"]): r["end"] - r["start"] + 1 for r in intervals.calendar_windows(fl).collect()}
    assert {y for _, y in got} == {1998, 1999, 2000, 2001}
    assert got["New Year", 1998] == 8 and got["Winter", 1999] == 31 + 31 + 28 and got["Christmas", 2001] == 14


# ---- runs

@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("gap", [1, 3])
def test_runs_as_plain(spark, width, gap):
    rows = rows_of_keys(500, 5, times=120)
    got = streaks.runs(spark.createDataFrame(rows, "k string, t long, v long"), ["k"], "t", ["v"], gap=gap, slice_width=width)
    want = Counter()
    for key in {k for k, _, _ in rows}:
        sums = defaultdict(list)
        for k, t, v in rows:
            if k == key and t is not None:
                sums[t].append(v)
        run = []
        for t in [*sorted(sums), None]:
            if run and (t is None or t - run[-1] > gap):
                vs = [v for x in run for v in sums[x] if v is not None]
                want[key, run[0], run[-1], len(run), sum(vs) if vs else None] += 1
                run = []
            run.append(t)
    assert Counter((r["k"], r["start"], r["end"], r["points"], r["v"]) for r in got.collect()) == want


def test_runs_of_a_hot_key_cross_slices(spark):
    """One key with a day in every slice for a thousand days is one run."""
    df = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("t"), F.lit(1).alias("n"))
    got = streaks.runs(df, ["k"], "t", ["n"], slice_width=32)
    assert tuple(got.filter("k = 'hot'").first()) == ("hot", 0, 999, 1000, 1000) and got.count() == 2001
    assert re.search(r"Exchange hashpartitioning\(k#\d+, _slice#\d+L", plan(got))


# ---- ranks

@pytest.mark.parametrize("descending", [True, False])
def test_ranks_as_windows(spark, descending):
    df = spark.createDataFrame(rows_of_keys(400, 6), "k string, t long, v long").select("k", "t", "v")
    df.createOrReplaceTempView("ranked")
    order = "partition by k order by v " + ("desc" if descending else "asc")
    want = spark.sql(f"select k, t, v, cast(rank() over ({order}) as long), cast(dense_rank() over ({order}) as long), cume_dist() over ({order}),"
                     f" percent_rank() over ({order}) from ranked where v is not null")
    got = ranks.rank_rows(df, ["k"], "v", descending)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert Counter(map(tuple, ranks.rank_rows(df, ["k"], "v", descending, top=3).collect())) == Counter(t for t in map(tuple, want.collect()) if t[3] <= 3)


def test_ranked_rows_are_never_sorted_by_group(spark):
    """The window is over distinct values; rows meet their value's rank in a join."""
    df = spark.range(3000).select((F.col("id") % 2).alias("k"), (F.col("id") % 50).alias("v"))
    p = plan(ranks.rank_rows(df, ["k"], "v"))
    assert re.search(r"Window.*\n(.*\n)*.*HashAggregate\(keys=\[k#\d+L, v#\d+L\], functions=\[partial_count", p)


@pytest.mark.parametrize("width", WIDTHS)
def test_running_total_as_window(spark, width):
    rows = {(k, t): v for k, t, v in rows_of_keys(400, 7) if t is not None}
    df = spark.createDataFrame([(k, t, v) for (k, t), v in rows.items()], "k string, t long, v long")
    got = ranks.running_total(df, ["k"], "t", "v", "total", slice_width=width)
    want = Counter((k, t, v, sum(w or 0 for (q, u), w in rows.items() if q == k and u <= t)) for (k, t), v in rows.items())
    assert Counter(map(tuple, got.collect())) == want


# ---- subtotals

def flights_of(spark, rows):
    names = ["carrier", "origin", "year", "month", "day_of_month", "day_of_week", "dep_delay", "cancelled"]
    full = [{**dict.fromkeys(S.FLIGHT_COLUMNS), **dict(zip(names, r))} for r in rows]
    return spark.createDataFrame([tuple(f[c] for c in S.FLIGHT_COLUMNS) for f in full], S.FLIGHTS_SCHEMA)


def test_totals_differ_from_null_groups(spark):
    fl = flights_of(spark, [(None, "A", 1999, 1, 1, 1, 20, 0), ("x", "A", 1999, 1, 1, 1, 5, 1), (None, None, 1999, None, 1, 1, None, None)])
    got = {(r["carrier"], r["origin"], r["month"], r["level"]): (r["flights"], r["delayed_flights"], r["cancelled_flights"], r["delay_minutes"]) for r in cubes.delay_cube(fl).collect()}
    assert got[None, None, None, 7] == (3, 1, 1, 20) and got[None, None, None, 0] == (1, 0, 0, 0)
    assert got[None, None, None, 3] == (2, 1, 0, 20)  # the carrier is missing, the rest is summed over
    assert got["x", None, None, 3] == (1, 0, 1, 0) and len([k for k in got if k[3] == 7]) == 1


def test_expand_is_over_the_pre_aggregate(spark):
    for name in ("delay_cube", "calendar_rollup", "carrier_sets"):
        p = plan(E.queries()[name](spark, SF01))
        assert p.count("lineitem.parquet") == 1
        assert re.search(r"Expand .*\n(.*\n)*?.*HashAggregate\(keys=\[[^\]]*\], functions=\[count", p), name


def test_counts_of_loads_add_up(spark):
    r = random.Random(8)
    rows = [(r.choice(["x", "y", None]), r.choice("AB"), 1999, r.randrange(1, 4), 1, 1, r.choice([None, 5, 40]), r.choice([0, 1])) for _ in range(200)]
    keys = ["carrier", "origin", "month"]
    halves = cubes.base_counts(flights_of(spark, rows[:90]), keys).unionByName(cubes.base_counts(flights_of(spark, rows[90:]), keys))
    assert Counter(map(tuple, cubes.subtotals(halves, keys).collect())) == Counter(map(tuple, cubes.delay_cube(flights_of(spark, rows)).collect()))


# ---- quantiles

def test_quantiles_as_sorted_lists(spark):
    import math
    import statistics

    rows = rows_of_keys(700, 9)
    df = spark.createDataFrame(rows, "k string, t long, v long")
    shares = {"least": 0, "third": 333, "p50": 500, "p95": 950, "most": 1000}
    halves = [quantiles.histogram(df.filter("t % 2 = 0"), ["k"], "v"), quantiles.histogram(df.filter("t % 2 <> 0 or t is null"), ["k"], "v")]
    got = quantiles.quantiles(quantiles.merged(halves, ["k"]), ["k"], shares)
    want = set()
    for key in {k for k, _, _ in rows}:
        vs = sorted(v for k, _, v in rows if k == key and v is not None)
        want.add((key, len(vs), *[vs[max(1, math.ceil(len(vs) * s / 1000)) - 1] for s in shares.values()], float(statistics.median(vs))))
    assert set(map(tuple, got.collect())) == want
    with pytest.raises(ValueError, match="thousandths"):
        quantiles.quantiles(halves[0], ["k"], {"x": 1001})


# ---- sketches

def test_sketches_merge_within_their_bound(spark):
    df = spark.range(200_000).select((F.col("id") % 2).alias("g"), (F.col("id") % 7).alias("part"), F.when(F.col("id") % 10 > 0, F.col("id") % 30_011).alias("v"))
    stored = sketches.sketches(df, ["g", "part"], "v")
    got = {r["g"]: r["estimate"] for r in sketches.estimates(sketches.merged(stored, ["g"])).collect()}
    exact = {r["g"]: r["n"] for r in df.groupBy("g").agg(F.countDistinct("v").alias("n")).collect()}
    direct = {r["g"]: r["estimate"] for r in sketches.estimates(sketches.sketches(df, ["g"], "v")).collect()}
    for g, n in exact.items():
        assert abs(got[g] - n) <= sketches.BOUND * n + 1 and abs(direct[g] - n) <= sketches.BOUND * n + 1


# ---- sets

def test_route_changes_as_plain(spark):
    r = random.Random(10)
    rows = [(r.choice(["x", "y", None]), r.choice(["A", "B", None]), r.choice([1999, 2000]), r.choice([None, *range(1, 13)]), 1, 1, 5, 0) for _ in range(80)]
    pairs = defaultdict(set)
    for c, o, y, m, *_ in rows:
        if m is not None:
            pairs[y * 12 + m - 1].add((c, o))
    want = {(m // 12, m % 12 + 1, len(pairs[m] - pairs[m - 1]), len(pairs[m - 1] - pairs[m]), len(pairs[m] & pairs[m - 1]))
            for m in list(pairs) if m - 1 in pairs}
    assert {tuple(x) for x in coverage.route_changes(flights_of(spark, rows)).collect()} == want


def test_history_job(spark, tmp_path):
    from ontime_analytics.jobs import JOBS, run_job
    from ontime_analytics.sources.fixture import fixture_flights, master_lines_from_part, model_lines_from_part
    from ontime_analytics.sources.ingest import write_flights_lake

    d = "/root/testdata/sf0.001"
    write_flights_lake(fixture_flights(spark, d), str(tmp_path / "lake"))
    part = spark.read.parquet(f"{d}/part.parquet")
    master_lines_from_part(part).write.text(str(tmp_path / "master"))
    model_lines_from_part(part).write.text(str(tmp_path / "acftref"))
    names = run_job(spark, "history", str(tmp_path / "lake"), str(tmp_path / "out"), master=str(tmp_path / "master"), acftref=str(tmp_path / "acftref"),
                    params={"airport_delay_streaks": {"min_days": 3}})
    assert sorted(names) == sorted(JOBS["history"]) == sorted(p.name for p in (tmp_path / "out").iterdir())
    got = spark.read.json(str(tmp_path / "out" / "airport_delay_streaks" / "json"))
    assert got.count() == 0 or got.agg(F.min("days")).first()[0] >= 3


# ---- routes and events

def test_traffic_of_airports_with_one_end_only(spark):
    df = spark.createDataFrame([("A", "B", 20, 30, 0), ("A", None, 5, None, 1), (None, "C", None, 16, 0)], "origin string, dest string, dep_delay int, arr_delay int, cancelled int")
    got = {r["airport"]: tuple(r)[1:] for r in routes.airport_traffic(df).collect()}
    assert got == {"A": (2, 0, 1, 0, 1), "B": (0, 1, 0, 1, 0), "C": (0, 1, 0, 1, 0), None: (1, 1, 0, 0, 0)}
    p = plan(routes.airport_traffic(df))
    assert "Join" not in p and p.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("how", [SMALL, LARGE])
def test_before_and_after_as_plain(spark, how):
    import datetime

    r = random.Random(12)
    rows = [("hot" if i % 3 == 0 else r.choice(["x", "y", None]), "A", 1999, r.randrange(1, 13), r.randrange(1, 29), 1, r.choice([None, 5, 40]), r.choice([0, 1])) for i in range(400)]
    number = lambda y, m, d: (datetime.date(y, m, d) - datetime.date(1970, 1, 1)).days
    events = [("one", "hot", number(1999, 6, 1)), ("one", "x", number(1999, 6, 1)), ("two", "hot", number(1999, 6, 20)), ("none", "z", number(1999, 6, 1)), ("odd", None, number(1999, 6, 1)), ("null", "x", None)]
    got = routes.before_and_after(flights_of(spark, rows), spark.createDataFrame(events, "event string, carrier string, day int"), 30, how)
    want = defaultdict(lambda: [0, 0, 0])
    for c, _, y, m, d, _, delay, gone in rows:
        for e, carrier, day in events:
            if c is not None and c == carrier and day is not None and -30 <= number(y, m, d) - day < 30:
                phase = want[e, "before" if number(y, m, d) < day else "after"]
                phase[0] += 1
                phase[1] += delay == 40
                phase[2] += gone
    assert {(r["event"], r["phase"]): [r["flights"], r["delayed_flights"], r["cancelled_flights"]] for r in got.collect()} == dict(want)


def test_destinations_reach_the_lake(spark, tmp_path):
    """Typed, written, read back; a lake without the column gives NULL."""
    from ontime_analytics.sources.fixture import fixture_flights
    from ontime_analytics.sources.flights import read_flights
    from ontime_analytics.sources.ingest import write_flights_lake

    fl = fixture_flights(spark, "/root/testdata/sf0.001")
    write_flights_lake(fl, str(tmp_path / "new"))
    write_flights_lake(fl.drop("dest"), str(tmp_path / "old"))
    assert Counter(map(tuple, routes.airport_traffic(read_flights(spark, str(tmp_path / "new"))).collect())) == Counter(map(tuple, routes.airport_traffic(fl).collect()))
    assert [r["dest"] for r in read_flights(spark, str(tmp_path / "old")).select("dest").distinct().collect()] == [None]
