"""Cross-query invariants on the sf0.01 fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from ontime_analytics.plans.catalog import build


def total(df, col):
    return df.agg(F.sum(col)).collect()[0][0]


def test_delayed_totals_agree(flights01, aircraft01):
    n = [total(build(name, flights01, aircraft01), "delayed_flights")
         for name in ("delays_by_day_of_week", "delays_by_day_of_month", "delays_by_month",
                      "delays_by_model_all", "monthly_airlines_delays")]
    assert len(set(n)) == 1 and n[0] > 0
    assert total(build("distance_impact", flights01), "delayed_flights") == n[0]


def test_flight_totals_equal_table_count(flights01):
    rows = flights01.count()
    for name in ("delay_by_year", "distance_impact", "cancellations_by_carrier",
                 "monthly_airlines_delays", "cancellation_code_counts"):
        assert total(build(name, flights01), "flights") == rows, name


def test_cancellation_totals_agree(flights01):
    by_reason = {r.reason: r.flights for r in build("cancellations_by_reason", flights01).collect()}
    assert by_reason.pop("All Flights") == flights01.count()
    cancelled = sum(by_reason.values())
    assert total(build("cancellations_by_carrier", flights01), "cancelled_flights") == cancelled
    assert total(build("cancellations_by_month_reason", flights01), "flights") == cancelled
    assert total(build("distance_impact", flights01), "cancelled_flights") == cancelled


def test_model_counts_partition_the_flights(flights01, aircraft01):
    allf = total(build("flights_delays_by_model", flights01, aircraft01), "flights")
    unmatched = flights01.count() - allf
    assert 0 < unmatched < flights01.count()
    rows = {r.model: r.delayed_flights for r in build("delays_by_model_all", flights01, aircraft01).collect()}
    inner = {r.model: r.delayed_flights
             for r in build("flights_delays_by_model", flights01, aircraft01).collect()}
    assert {m: v for m, v in rows.items() if m != "Unavailable"} == inner


def test_threshold_variants_are_subsets(flights01, aircraft01):
    base = {r.origin: r.delayed_flights for r in build("airport_delay_count", flights01).collect()}
    up = build("airport_delay_count_upper", flights01, min_count=190).collect()
    assert up and all(base[r.origin] == r.delayed_flights >= 190 for r in up)
    top = build("airport_count_top", flights01, k=5).collect()
    assert [r.delayed_flights for r in top] == sorted(base.values(), reverse=True)[:5]


def test_airport_listings_are_sorted(flights01):
    rows = [(r.delayed_flights, r.origin) for r in build("airport_delay_count", flights01).collect()]
    assert rows == sorted(rows) and len(rows) == 120
    pct = [(r.delay_percent, r.origin) for r in build("airport_delay_percent", flights01).collect()]
    assert pct == sorted(pct)
