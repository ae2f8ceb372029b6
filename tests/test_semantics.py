"""Hand-written rows for the parsing rules (P2-P13) and the quirk decisions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ontime_analytics import schema as S
from ontime_analytics.functions import calendar, parse
from ontime_analytics.operators import (
    airports,
    cancellations,
    delays,
    dst,
    impact,
    models,
    reasons,
)
from ontime_analytics.operators.aircraft import ModelJoin, aircraft_dimension
from ontime_analytics.sources.flights import type_flights
from ontime_analytics.sources.registry import parse_model_lookup, parse_registry_master

# the sample record of the dataset description (note ' 0' and 'NA ')
SAMPLE = "1987,10,14,3,741,730,912,849,PS,1451,NA,91,79,NA,23,11,SAN,SFO,447,NA,NA, 0,NA ,0,NA,NA,NA,NA,NA"


def raw_row(**over):
    base = dict(zip(S.RAW_COLUMNS, SAMPLE.split(",")))
    base.update(over)
    return tuple(base[c] for c in S.RAW_COLUMNS)


def flights_of(spark, rows):
    return type_flights(spark.createDataFrame([raw_row(**r) for r in rows], ", ".join(f"{c} string" for c in S.RAW_COLUMNS)))


def col_values(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_sample_record_types(spark):
    r = flights_of(spark, [{}]).collect()[0]
    assert (r.year, r.month, r.day_of_month, r.day_of_week) == (1987, 10, 14, 3)
    assert r.carrier == "PS" and r.tail_num == "NA" and r.origin == "SAN"
    assert (r.arr_delay, r.dep_delay, r.distance) == (23, 11, 447)
    assert r.cancelled == 0  # ' 0' is not an integer for the strict parser -> default 0
    assert r.cancel_code_raw == "NA " and r.cancel_code == "NA "
    assert r.carrier_delay is None


def test_strict_int(spark):
    vals = ["15", "16", "-3", "+7", "NA", "", " 20", "5.7", "99999999999", None, "1e3"]
    got = col_values(spark, vals, parse.strict_int)
    assert got == [15, 16, -3, 7, None, None, None, None, None, None, None]


def test_has_delay_is_strict_and_null_safe(spark):
    got = col_values(spark, ["15", "16", "NA", "", " 20", "-30"],
                     lambda c: parse.has_delay(parse.strict_int(c)))
    assert got == [False, True, False, False, False, False]


def test_distance_bands(spark):
    vals = ["0", "500", "501", "1000", "1001", "4999", "5000", "5001", "-1", "NA", "abc"]
    got = col_values(spark, vals, lambda c: parse.distance_band(parse.strict_int(c)))
    assert got == ["0-500", "0-500", "501-1000", "501-1000", "1001-1500", "4501-5000",
                   "4501-5000", "> 5000", "NA", "NA", "NA"]


def test_distance_band_labels_are_the_twelve(spark):
    ds = [str(d) for d in range(-1, 5600, 7)] + ["NA"]
    got = set(col_values(spark, ds, lambda c: parse.distance_band(parse.strict_int(c))))
    expected = {"0-500", "> 5000", "NA"} | {f"{lo}-{lo + 499}" for lo in range(501, 5000, 500)}
    assert got == expected and len(got) == 12


def test_cancellation_reason(spark):
    got = col_values(spark, ["A", "b", "C", "d", "NA", "na", "Z", "", "NA "],
                     parse.cancellation_reason)
    assert got == ["Carrier", "Weather", "NAS", "Security", "Not Available", "Not Available",
                   None, None, None]


def test_tail_key(spark):
    got = col_values(spark, ["N123", "NA", "N", "N12NN", "123", "NN1", None], parse.tail_key)
    assert got == ["123", "NA", "N", "12NN", "123", "N1", None]


def test_weekday_and_month_names(spark):
    got = col_values(spark, ["1", "7", "8", "0", "x"],
                     lambda c: parse.weekday_name(parse.strict_int(c)))
    assert got == ["Monday", "Sunday", None, None, None]
    got = col_values(spark, ["1", "12", "13"], lambda c: parse.month_name(parse.strict_int(c)))
    assert got == ["January", "December", None]


def test_truncated_and_exact_mean(spark):
    df = spark.createDataFrame([(179, 10), (17, 1), (5, 0)], "t long, n long")
    got = df.select(parse.truncated_mean("t", "n").alias("a"), parse.exact_mean("t", "n").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(17.0, 17.9), (17.0, 17.0), (None, None)]


def _dst_rule_dates(first, last):
    """Independent brute force: walk the calendar day by day."""
    out = set()
    for y in range(first, last + 1):
        sundays = lambda m: [d for d in (dt.date(y, m, 1) + dt.timedelta(i) for i in range(31))
                             if d.month == m and d.weekday() == 6]
        if y < 2007:
            out |= {sundays(4)[0], sundays(10)[-1]}
        else:
            out |= {sundays(3)[1], sundays(11)[0]}
    return {(d.year, d.month, d.day) for d in out}


@pytest.mark.parametrize("first, last, want", [(1987, 2008, (1987, 2008)), (1987, None, (1987, 2030)), (None, 2000, (1980, 2000))])
def test_dst_days_match_brute_force(spark, first, last, want):
    """The predicate, and the filter with its windows, over every day of 51 years."""
    start = dt.date(1980, 1, 1)
    days = [start + dt.timedelta(i) for i in range((dt.date(2031, 1, 1) - start).days)]
    df = spark.createDataFrame([(d.year, d.month, d.day) for d in days] + [(None, 4, 3), (0, 4, 3), (99999, 3, 8)],
                               "year int, month int, day_of_month int")
    expected = _dst_rule_dates(*want)
    for kept in (df.filter(calendar.is_dst_crossover(first_year=first, last_year=last)), calendar.filter_dst_days(df, first, last)):
        assert {(r.year, r.month, r.day_of_month) for r in kept.collect()} == expected
    if (first, last) == (1987, 2008):
        assert len(expected) == 44 and (1988, 4, 3) in expected and (2008, 11, 2) in expected


def test_dst_exact_dates_not_prefixes(spark):
    # 1988-4-3 is a crossover day; 1988-4-30 only shares the text prefix
    fl = flights_of(spark, [dict(Year="1988", Month="4", DayofMonth="3", DepDelay="30"),
                            dict(Year="1988", Month="4", DayofMonth="30", DepDelay="40"),
                            dict(Year="1988", Month="4", DayofMonth="3", DepDelay="NA")])
    r = dst.dst_average_delay(fl).collect()
    assert [(x.year, x.avg_delay) for x in r] == [(1988, 30.0)]
    p = dst.dst_delay_percent(fl).collect()
    assert [(x.year, x.delay_percent) for x in p] == [(1988, 100.0)]


def test_delay_by_year_counts_all_flights(spark):
    fl = flights_of(spark, [dict(DepDelay="16"), dict(DepDelay="15"), dict(DepDelay="NA"),
                            dict(DepDelay=" 20"), dict(Year="1988", DepDelay="100")])
    got = {r.year: (r.delay_minutes, r.flights) for r in delays.delay_by_year(fl).collect()}
    assert got == {1987: (16, 4), 1988: (100, 1)}


def test_weekday_groups_with_zero_are_kept(spark):
    fl = flights_of(spark, [dict(DayOfWeek="1", DepDelay="5"), dict(DayOfWeek="2", DepDelay="50")])
    got = {r.day_name: r.delayed_flights for r in delays.delays_by_day_of_week(fl).collect()}
    assert got == {"Monday": 0, "Tuesday": 1}


def test_net_delay_drops_unparsable(spark):
    fl = flights_of(spark, [dict(ArrDelay="-5", DepDelay="6"), dict(ArrDelay="NA", DepDelay="60"),
                            dict(ArrDelay="-5", DepDelay="5")])
    got = [(r.day_of_week, r.flights) for r in delays.net_delay_by_day_of_week(fl).collect()]
    assert got == [(3, 1)]


def test_airport_percent_uses_parsable_delays_only(spark):
    fl = flights_of(spark, [dict(Origin="X", DepDelay="30"), dict(Origin="X", DepDelay="0"),
                            dict(Origin="X", DepDelay="NA"), dict(Origin="Y", DepDelay="NA")])
    got = {r.origin: r.delay_percent for r in airports.airport_delay_percent(fl).collect()}
    assert got == {"X": 50.0}
    avg = airports.airport_average_delay(
        flights_of(spark, [dict(Origin="X", DepDelay="16"), dict(Origin="X", DepDelay="19")])).collect()
    assert [(r.avg_delay_trunc, r.avg_delay) for r in avg] == [(17.0, 17.5)]


def test_cancellations_by_reason_total_counts_all_flights(spark):
    fl = flights_of(spark, [dict(Cancelled="1", CancellationCode="b"),
                            dict(Cancelled="1", CancellationCode="Z"),
                            dict(Cancelled="1", CancellationCode="A"),
                            dict(Cancelled="0", CancellationCode="A"),
                            dict(Cancelled="x", CancellationCode="")])
    got = {r.reason: r.flights for r in cancellations.cancellations_by_reason(fl).collect()}
    assert got == {"Weather": 1, None: 1, "Carrier": 1, "All Flights": 5}


def test_cancellation_code_counts_keep_raw_and_empty(spark):
    fl = flights_of(spark, [dict(CancellationCode=""), dict(CancellationCode="NA"),
                            dict(CancellationCode="b"), dict(CancellationCode="B")])
    got = {r.cancel_code_raw: r.flights for r in cancellations.cancellation_code_counts(fl).collect()}
    assert got == {"": 1, "NA": 1, "b": 1, "B": 1}


def test_carriers_without_cancellations_are_kept(spark):
    fl = flights_of(spark, [dict(UniqueCarrier="AA", Cancelled="1"), dict(UniqueCarrier="BB")])
    got = {r.carrier: (r.flights, r.cancelled_flights)
           for r in cancellations.cancellations_by_carrier(fl).collect()}
    assert got == {"AA": (1, 1), "BB": (1, 0)}


def test_delay_reasons(spark):
    fl = flights_of(spark, [dict(CarrierDelay="5", WeatherDelay="0", NASDelay="NA", SecurityDelay="",
                                 LateAircraftDelay="-2"),
                            dict(CarrierDelay="7", WeatherDelay="3", NASDelay="NA", SecurityDelay="",
                                 LateAircraftDelay="4")])
    counts = {r.reason: r.flights for r in reasons.delay_reason_counts(fl).collect()}
    assert counts == {"Carrier Delay": 2, "Weather Delay": 1, "NAS Delay": 0,
                      "Security Delay": 0, "Late Aircraft Delay": 1}
    mins = {r.reason: (r.minutes, r.flights, r.avg_minutes)
            for r in reasons.delay_reason_minutes(fl).collect()}
    assert mins == {"Carrier Delay": (12, 2, 6.0), "Weather Delay": (3, 2, 1.5),
                    "NAS Delay": (0, 0, None), "Security Delay": (0, 0, None),
                    "Late Aircraft Delay": (2, 2, 1.0)}


def test_distance_impact_named_columns(spark):
    fl = flights_of(spark, [dict(Distance="100", DepDelay="30"), dict(Distance="100", Cancelled="1"),
                            dict(Distance="NA")])
    got = {r.distance_band: (r.flights, r.cancelled_flights, r.delayed_flights)
           for r in impact.distance_impact(fl).collect()}
    assert got == {"0-500": (2, 1, 1), "NA": (1, 0, 0)}


def test_monthly_airlines_distinct_carriers(spark):
    fl = flights_of(spark, [dict(UniqueCarrier="AA", DepDelay="30"), dict(UniqueCarrier="AA"),
                            dict(UniqueCarrier="BB"), dict(Month="11", UniqueCarrier="CC")])
    got = {(r.year, r.month): (r.flights, r.airlines, r.delayed_flights)
           for r in impact.monthly_airlines_delays(fl).collect()}
    assert got == {(1987, 10): (3, 2, 1), (1987, 11): (1, 1, 0)}


@pytest.fixture()
def registry(spark):
    master = spark.createDataFrame(
        [("123  " + " " * 32 + "000777",), ("45   " + " " * 32 + "000888",),
         ("12NN " + " " * 32 + "000777",), ("45   " + " " * 32 + "000999",),
         ("678  " + " " * 32 + "000555",)], "value string")
    lookup = spark.createDataFrame(
        [("000777" + " " * 33 + "B737".ljust(19),), ("000888" + " " * 33 + "A320".ljust(19),),
         ("000999" + " " * 33 + "A321".ljust(19),)], "value string")
    return aircraft_dimension(parse_registry_master(master), parse_model_lookup(lookup))


def test_aircraft_dimension_one_row_per_tail(registry):
    got = {r.tail: (r.mfr_model_code, r.model) for r in registry.collect()}
    # tail 45 is registered twice: the greatest (model, code) is kept; 678 has no model
    assert got == {"123": ("000777", "B737"), "45": ("000999", "A321"), "12NN": ("000777", "B737")}


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_model_queries_both_join_strategies(spark, registry, strategy):
    fl = flights_of(spark, [dict(TailNum="N123", DepDelay="20"), dict(TailNum="N123", DepDelay="1"),
                            dict(TailNum=" N45 ", DepDelay="40"), dict(TailNum="NA", DepDelay="60"),
                            dict(TailNum="N999", DepDelay="70"), dict(TailNum="N12NN", DepDelay="NA")])
    j = ModelJoin(strategy=strategy)
    cnt = {r.model: r.delayed_flights for r in models.model_delay_count(fl, registry, j).collect()}
    assert cnt == {"B737": 1, "A321": 1, "Unavailable": 1}  # the NA tail is excluded (F3)
    pct = {r.model: r.delay_percent for r in models.model_delay_percent(fl, registry, j).collect()}
    assert pct == {"B737": 50.0, "A321": 100.0, "Unavailable": 100.0}  # NA tail included
    inner = {r.model: (r.flights, r.delayed_flights)
             for r in models.flights_delays_by_model(fl, registry, j).collect()}
    assert inner == {"B737": (3, 1), "A321": (1, 1)}
    allf = {r.model: r.delayed_flights for r in models.delays_by_model_all(fl, registry, j).collect()}
    assert allf == {"B737": 1, "A321": 1, "Unavailable": 2}


def test_size_check_falls_back_to_shuffle(spark, registry):
    assert ModelJoin().use_broadcast(registry)
    assert not ModelJoin(broadcast_max_bytes=10).use_broadcast(registry)
    assert not ModelJoin(aircraft_rows=10**9).use_broadcast(registry)
    # a forced broadcast goes through the same check; a frame with wide rows is measured, not assumed
    assert ModelJoin(strategy="broadcast").use_broadcast(registry)
    with pytest.raises(ValueError, match="broadcast_max_bytes"):
        ModelJoin(strategy="broadcast", aircraft_rows=10**9).use_broadcast(registry)
    wide = spark.createDataFrame([("1", "x" * 5000)], "tail string, model string")
    assert not ModelJoin(broadcast_max_bytes=4000).use_broadcast(wide)


def test_empty_input(spark):
    """No flights: every grouped result is empty, the cancellation report still
    has its total row (a global count), the reason reports have no pair to count."""
    from ontime_analytics.plans.catalog import QUERIES, SUMMARIES, build

    fl = spark.createDataFrame([], S.FLIGHTS_SCHEMA)
    ac = spark.createDataFrame([], "tail string, mfr_model_code string, model string")
    j = ModelJoin(strategy="broadcast")
    for name, q in QUERIES.items():
        if not q.flights:
            continue
        rows = [tuple(r) for r in build(name, fl, ac, **({"join": j} if q.needs_aircraft else {})).collect()]
        assert rows == ([("All Flights", 0)] if name == "cancellations_by_reason" else []), name
    for s in SUMMARIES.values():
        summary = s.make(fl, ac, j) if s.needs_aircraft else s.make(fl)
        for name, view in s.views.items():
            rows = [tuple(r) for r in view(summary).collect()]
            assert rows == ([("All Flights", 0)] if name == "cancellations_by_reason" else []), name
