"""The named queries: one entry per user-level result of the survey (Q1-Q33).

A :class:`Query` binds an analysis function to the inputs it needs.
:func:`build` runs it on any typed ``flights`` (and ``aircraft``) DataFrame
- the Parquet lake in production - and :func:`fixture_query` on the stand-in
tables derived from a test-data directory.  ``FIXTURE_PARAMS`` are the
threshold / k values that select a meaningful subset of the small fixture
(the published cut-offs were found on the full 1987-2008 data).
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_analytics.operators import (
    airports,
    cancellations,
    delays,
    dst,
    impact,
    models,
    reasons,
    summaries,
)
from ontime_analytics.operators.aircraft import ModelJoin, aircraft_dimension, aircraft_rows_bound
from ontime_analytics.plans.history import HISTORY
from ontime_analytics.plans.history import PARAMS as HISTORY_PARAMS
from ontime_analytics.sources.fixture import fixture_flight_lines, fixture_flights, fixture_registry
from ontime_analytics.sources.flights import bad_line_counts, parse_flight_lines, type_flights


@dataclass(frozen=True)
class Query:
    fn: Callable[..., DataFrame]
    needs_aircraft: bool = False
    flights: bool = True  # False: the query reads the aircraft dimension only
    doc: str = ""
    small_result: bool = True  # False: the result grows with the input (no single-file sink)


def _q(fn, needs_aircraft=False, flights=True, small_result=True):
    return Query(fn, needs_aircraft, flights, (fn.__doc__ or "").strip().splitlines()[0],
                 small_result)


def _aircraft_dim(aircraft: DataFrame) -> DataFrame:
    """Q17: the registry join itself - (tail, mfr_model_code, model)."""
    return aircraft


QUERIES: dict[str, Query] = {
    "delay_by_year": _q(delays.delay_by_year),
    "delays_by_day_of_week": _q(delays.delays_by_day_of_week),
    "delays_by_day_of_month": _q(delays.delays_by_day_of_month),
    "delays_by_month": _q(delays.delays_by_month),
    "net_delay_by_day_of_week": _q(delays.net_delay_by_day_of_week),
    "airport_delay_count": _q(airports.airport_delay_count),
    "airport_delay_count_upper": _q(airports.airport_delay_count_upper),
    "airport_delay_count_lower": _q(airports.airport_delay_count_lower),
    "airport_average_delay": _q(airports.airport_average_delay),
    "airport_delay_percent": _q(airports.airport_delay_percent),
    "airport_delay_percent_upper": _q(airports.airport_delay_percent_upper),
    "airport_delay_percent_lower": _q(airports.airport_delay_percent_lower),
    "airport_count_top": _q(airports.airport_count_top),
    "airport_count_bottom": _q(airports.airport_count_bottom),
    "airport_percent_top": _q(airports.airport_percent_top),
    "airport_percent_bottom": _q(airports.airport_percent_bottom),
    "dst_average_delay": _q(dst.dst_average_delay),
    "dst_delay_percent": _q(dst.dst_delay_percent),
    "aircraft_dim": _q(_aircraft_dim, needs_aircraft=True, flights=False, small_result=False),
    "model_delay_count": _q(models.model_delay_count, needs_aircraft=True),
    "model_delay_count_upper": _q(models.model_delay_count_upper, needs_aircraft=True),
    "model_average_delay": _q(models.model_average_delay, needs_aircraft=True),
    "model_average_delay_upper": _q(models.model_average_delay_upper, needs_aircraft=True),
    "model_delay_percent": _q(models.model_delay_percent, needs_aircraft=True),
    "model_delay_percent_upper": _q(models.model_delay_percent_upper, needs_aircraft=True),
    "cancellations_by_reason": _q(cancellations.cancellations_by_reason),
    "cancellations_by_month_reason": _q(cancellations.cancellations_by_month_reason),
    "cancellations_by_carrier": _q(cancellations.cancellations_by_carrier),
    "cancellation_code_counts": _q(cancellations.cancellation_code_counts),
    "delay_reason_counts": _q(reasons.delay_reason_counts),
    "delay_reason_minutes": _q(reasons.delay_reason_minutes),
    "distance_impact": _q(impact.distance_impact),
    "monthly_airlines_delays": _q(impact.monthly_airlines_delays),
    "flights_delays_by_model": _q(models.flights_delays_by_model, needs_aircraft=True),
    "delays_by_model_all": _q(models.delays_by_model_all, needs_aircraft=True),
    "model_count_top": _q(models.model_count_top, needs_aircraft=True),
    "model_count_bottom": _q(models.model_count_bottom, needs_aircraft=True),
    "model_average_top": _q(models.model_average_top, needs_aircraft=True),
    "model_percent_top": _q(models.model_percent_top, needs_aircraft=True),
}

#: What jobs, ``build`` and the driver know: the results above, and the further ones of :mod:`.history`.
ALL_QUERIES: dict[str, Query] = {**QUERIES, **{n: _q(fn, needs_aircraft=a, small_result=small) for n, (fn, a, small) in HISTORY.items()}}

# Parameters for runs on the driver's sf0.01 fixture (FIXTURES.md): the
# published cut-offs select nothing (or everything) on it, and there are only
# 48 model groups, so the model rankings use k=10.
FIXTURE_PARAMS: dict[str, dict] = {
    "airport_delay_count_upper": {"min_count": 190},
    "airport_delay_count_lower": {"max_count": 155},
    "airport_delay_percent_upper": {"min_pct": 43.5},
    "airport_delay_percent_lower": {"max_pct": 38.0},
    "airport_count_top": {"k": 50},
    "airport_count_bottom": {"k": 50},
    "airport_percent_top": {"k": 50},
    "airport_percent_bottom": {"k": 50},
    "model_delay_count_upper": {"min_count": 380},
    "model_average_delay_upper": {"min_avg": 48.0},
    "model_delay_percent_upper": {"min_pct": 42.5},
    "model_count_top": {"k": 10},
    "model_count_bottom": {"k": 10},
    "model_average_top": {"k": 10},
    "model_percent_top": {"k": 10},
    **HISTORY_PARAMS,
}


@dataclass(frozen=True)
class Summary:
    """One aggregate several queries are views of (``views[name](summary, **params)``)."""
    make: Callable[..., DataFrame]
    views: dict
    needs_aircraft: bool = False


SUMMARIES: dict[str, Summary] = {
    "airports": Summary(airports.airport_summary, airports.FROM_SUMMARY),
    "models": Summary(models.model_summary, models.FROM_SUMMARY, needs_aircraft=True),
    "dst": Summary(dst.every_year, dst.FROM_SUMMARY),
    # job-only: the single queries of these keep their direct one-key plans
    "calendar": Summary(summaries.calendar_summary, summaries.CALENDAR_VIEWS),
    "cancellations": Summary(summaries.cancellation_summary, summaries.CANCELLATION_VIEWS),
}


def build(name: str, flights: DataFrame | None, aircraft: DataFrame | None = None,
          **params) -> DataFrame:
    """Plan query ``name`` over typed inputs (lazy; nothing runs until an action)."""
    q = ALL_QUERIES[name]
    args = []
    if q.flights:
        args.append(flights)
    if q.needs_aircraft:
        if aircraft is None:
            raise ValueError(f"query {name!r} needs the aircraft dimension")
        args.append(aircraft)
    return q.fn(*args, **params)


def takes_join(name: str) -> bool:
    """Whether the query can be told how flights meet the aircraft dimension."""
    return "join" in inspect.signature(ALL_QUERIES[name].fn).parameters


def fixture_inputs(spark: SparkSession, sf_dir: str, name: str):
    """(flights, aircraft, join options) for ``name`` on the fixture tables.

    The registry join is part of each query's plan.  Only the MASTER lines are
    counted before, the proven bound for the broadcast check."""
    q = ALL_QUERIES[name]
    flights = fixture_flights(spark, sf_dir) if q.flights else None
    aircraft, join = None, None
    if q.needs_aircraft:
        master, lookup = fixture_registry(spark, sf_dir)
        aircraft = aircraft_dimension(master, lookup)
        join = ModelJoin(aircraft_rows=aircraft_rows_bound(master)) if q.flights and takes_join(name) else None
    return flights, aircraft, join


def fixture_query(name: str, **overrides) -> Callable[[SparkSession, str], DataFrame]:
    """``(spark, sf_dir) -> DataFrame`` running ``name`` on the fixture tables."""
    params = {**FIXTURE_PARAMS.get(name, {}), **overrides}

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        flights, aircraft, join = fixture_inputs(spark, sf_dir, name)
        extra = {"join": join} if join is not None and "join" not in params else {}
        return build(name, flights, aircraft, **params, **extra)

    run.__name__ = name
    run.__doc__ = ALL_QUERIES[name].doc
    return run


def parsed_line_totals(lines: DataFrame) -> DataFrame:
    """S1 and P1 on raw text lines: per year and raw cancellation code, what the typed fields add up to."""
    return type_flights(parse_flight_lines(lines)).groupBy("year", "cancel_code_raw").agg(
        F.count(F.lit(1)).alias("flights"),
        F.sum("dep_delay").alias("dep_delay_minutes"),
        F.count("arr_delay").alias("timed_arrivals"),
        F.sum("distance").alias("miles"),
        F.count_if(F.col("tail_num") == "NA").alias("unknown_tails"),
        F.sum("cancelled").alias("cancelled_flights"),
        F.sum("late_aircraft_delay").alias("late_aircraft_minutes"),
        F.count("carrier").alias("with_carrier"),
    )


#: Queries that start from the raw text lines.
LINE_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "parsed_line_totals": parsed_line_totals,
    "bad_rows": bad_line_counts,
}


def fixture_line_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return LINE_QUERIES[name](fixture_flight_lines(spark, sf_dir))

    run.__name__ = name
    return run
