"""Batch jobs: one command per analysis family, writing every result.

``python -m ontime_analytics <job> --flights DIR --out DIR [options]``

* ``--flights`` is either raw flight files (``--raw``, plain or ``.bz2``,
  ``--header`` if they still have one) or the typed Parquet lake written by
  ``ingest``.  A job over raw text that scans the flights more than once
  first types them once into a staged lake under ``spark.checkpoint.dir``
  (the text is parsed once, not once per result).
* ``--master`` / ``--acftref`` are the registry files (model jobs only).
* each result goes to ``OUT/<query>/csv`` and ``OUT/<query>/json``.
* ``--param QUERY.NAME=VALUE`` (repeatable) sets a threshold or ``k``, e.g.
  ``--param airport_delay_count_upper.min_count=92625 --param model_count_top.k=50``.

Results that are views of one shared aggregate (``plans.catalog.SUMMARIES``:
per origin, per model, per (date, carrier), per (month, code), per DST year)
are derived from it; the aggregate is computed once per job and stored under
``spark.checkpoint.dir``, so the flights are scanned once per summary instead
of once per result (``all``: 5 scans for 39 results).  Results are written
from a few driver threads as concurrent Spark jobs (``--parallel``).

``ingest`` lands raw files in a lake: ``python -m ontime_analytics ingest
--flights RAW_DIR --out LAKE_DIR [--header]``.  ``stream-ingest`` streams the
files of RAW_DIR that it has not seen yet into a lake of its own
(``--checkpoint DIR``, ``--max-files N``).  ``--flights`` may be given several
times to read several lakes together.  ``bad-rows`` writes a report on malformed
raw files to ``OUT/bad_rows``.

What a job stages under ``spark.checkpoint.dir`` is deleted when it ends, also
when it fails.
"""

from __future__ import annotations

import argparse
import inspect
import os
import sys
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ontime_analytics.operators.aircraft import ModelJoin, aircraft_dimension
from ontime_analytics.plans.catalog import ALL_QUERIES, SUMMARIES, build, takes_join
from ontime_analytics.plans.history import HISTORY
from ontime_analytics.session import delete_path, get_session, write_scratch
from ontime_analytics.sinks import write_csv, write_json
from ontime_analytics.sources import (
    bad_rows,
    ingest_flights,
    read_flights,
    read_flights_csv,
    read_model_lookup,
    read_registry_master,
)
from ontime_analytics.streaming import start_flight_ingest

JOBS: dict[str, tuple[str, ...]] = {
    "flight-delays": ("delay_by_year", "delays_by_day_of_week", "delays_by_day_of_month",
                      "delays_by_month"),
    "weekday-net-delays": ("net_delay_by_day_of_week",),
    "airports": ("airport_delay_count", "airport_delay_count_upper", "airport_delay_count_lower",
                 "airport_average_delay", "airport_delay_percent", "airport_delay_percent_upper",
                 "airport_delay_percent_lower", "airport_count_top", "airport_count_bottom",
                 "airport_percent_top", "airport_percent_bottom"),
    "dst": ("dst_average_delay", "dst_delay_percent"),
    "model-delays": ("model_delay_count", "model_delay_count_upper", "model_average_delay",
                     "model_average_delay_upper", "model_delay_percent", "model_delay_percent_upper",
                     "model_count_top", "model_count_bottom", "model_average_top", "model_percent_top"),
    "tail-delays": ("delays_by_model_all",),
    "delay-reasons": ("cancellation_code_counts", "delay_reason_counts", "delay_reason_minutes"),
    "cancellations": ("cancellations_by_reason", "cancellations_by_month_reason",
                      "cancellations_by_carrier"),
    "distance": ("distance_impact",),
    "airlines": ("monthly_airlines_delays", "flights_delays_by_model"),
    "aircraft": ("aircraft_dim",),
}
# every result in one run: the flights, the aircraft dimension and each
# summary are shared across all families
JOBS["all"] = tuple(dict.fromkeys(n for names in list(JOBS.values()) for n in names))
# joins in time, runs, ranks, subtotals, quantiles and sets: each a plan of its own, not part of "all"
JOBS["history"] = tuple(HISTORY)


def load_flights(spark: SparkSession, path: str | list[str], raw: bool, header: bool) -> DataFrame:
    return read_flights_csv(spark, path, header=header) if raw else read_flights(spark, path)


class Scratch:
    """Tables that a run stages in the shared folder, stored once (a lost
    executor re-reads them) and deleted at the end, also after a failure."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = write_scratch(df, name)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        for p in self.paths:
            delete_path(self.spark, p)


def run_job(spark: SparkSession, job: str, flights_path: str | list[str] | None, out: str, raw: bool = False,
            header: bool = False, master: str | None = None, acftref: str | None = None,
            params: dict[str, dict] | None = None, parallel: int = 4) -> list[str]:
    """Run every query of ``job`` and write its results; returns the query names.

    ``all`` without registry files runs every result that needs no aircraft."""
    names = JOBS[job]
    if job in ("all", "history") and not (master and acftref):
        names = tuple(n for n in names if not ALL_QUERIES[n].needs_aircraft)
        print("no --master/--acftref: the aircraft-model results are skipped", file=sys.stderr)
    with Scratch(spark) as scratch:
        _run(spark, job, names, scratch, flights_path, out, raw, header, master, acftref, params or {}, parallel)
    return list(names)


def _run(spark, job, names, scratch, flights_path, out, raw, header, master, acftref, params, parallel) -> None:
    needs_aircraft = any(ALL_QUERIES[n].needs_aircraft for n in names)
    needs_flights = any(ALL_QUERIES[n].flights for n in names)
    flights = load_flights(spark, flights_path, raw, header) if needs_flights else None
    if raw and flight_scans(names) > 1:  # the text is parsed once
        flights = scratch.store(flights, "staged-flights")
    aircraft, join = None, None
    if needs_aircraft:
        if not (master and acftref):
            raise SystemExit(f"job {job!r} needs --master and --acftref")
        aircraft = aircraft_dimension(read_registry_master(spark, master),
                                      read_model_lookup(spark, acftref))
        if needs_flights:  # build once, shared by all of the job's queries
            aircraft = scratch.store(aircraft, "aircraft")
            join = ModelJoin(aircraft_rows=aircraft.count())
    shared = shared_summaries(names, flights, aircraft, join, scratch, parallel)

    def write_one(name: str) -> None:
        q = ALL_QUERIES[name]
        kw = dict(params.get(name, {}))
        if name in shared:
            summary, views = shared[name]
            result = views[name](summary, **kw)
        else:
            if q.needs_aircraft and q.flights and takes_join(name):
                kw.setdefault("join", join)
            result = build(name, flights, aircraft, **kw)
        # computed once for both formats (a lost block is recomputed from lineage)
        result = result.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_csv(result, os.path.join(out, name, "csv"), single_file=q.small_result)
            write_json(result, os.path.join(out, name, "json"), single_file=q.small_result)
        finally:
            result.unpersist()

    # small result writes are submitted from a few driver threads as concurrent
    # Spark jobs, so the cluster is not idle between them
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for f in [pool.submit(write_one, n) for n in names]:
            f.result()


def plan_summaries(names) -> dict[str, list[str]]:
    """Which shared summary serves which results: greedily the summary that
    covers the most remaining results (ties: the smaller, listed first), as
    long as it serves at least two."""
    remaining = [n for n in names if ALL_QUERIES[n].flights]
    chosen: dict[str, list[str]] = {}
    while True:
        best = max(SUMMARIES, key=lambda k: sum(n in SUMMARIES[k].views for n in remaining),
                   default=None)
        covered = [n for n in remaining if best and n in SUMMARIES[best].views]
        if len(covered) < 2:
            return chosen
        chosen[best] = covered
        remaining = [n for n in remaining if n not in covered]


def flight_scans(names) -> int:
    """Scans of the flights a run of ``names`` makes (one per shared summary)."""
    plan = plan_summaries(names)
    shared = {n for ns in plan.values() for n in ns}
    return len(plan) + sum(1 for n in names if ALL_QUERIES[n].flights and n not in shared)


def shared_summaries(names, flights, aircraft, join, scratch: Scratch, parallel: int = 4) -> dict[str, tuple[DataFrame, dict]]:
    """For each chosen summary (:func:`plan_summaries`): compute it once (one
    scan of the flights), store it in the shared folder - it is small,
    and a lost executor then re-reads it instead of re-scanning - and map each
    of its query names to (stored summary, views).  The summaries are
    independent, so they are built as concurrent Spark jobs."""
    plan = plan_summaries(names)
    if not plan:
        return {}

    def build_one(kind: str) -> DataFrame:
        summary = SUMMARIES[kind]
        df = summary.make(flights, aircraft, join) if summary.needs_aircraft else summary.make(flights)
        return scratch.store(df, f"summary-{kind}")

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        stored = dict(zip(plan, pool.map(build_one, plan)))
    return {n: (stored[kind], SUMMARIES[kind].views) for kind, wanted in plan.items() for n in wanted}


def query_params(name: str) -> set[str]:
    """The parameters that a query takes from the command line."""
    return set(inspect.signature(ALL_QUERIES[name].fn).parameters) - {"flights", "aircraft", "join"}


def parse_params(items: list[str]) -> dict[str, dict]:
    """``["query.name=value", ...]`` -> ``{query: {name: int | float | str}}``."""
    out: dict[str, dict] = {}
    for item in items:
        key, _, raw = item.partition("=")
        query, _, name = key.partition(".")
        if not (query and name and raw) or query not in ALL_QUERIES:
            raise SystemExit(f"bad --param {item!r}: expected QUERY.NAME=VALUE for a known query")
        if name not in query_params(query):
            raise SystemExit(f"bad --param {item!r}: {query} takes {', '.join(sorted(query_params(query))) or 'no parameter'}")
        value: int | float | str = raw
        for cast in (int, float):
            try:
                value = cast(raw)
                break
            except ValueError:
                pass
        out.setdefault(query, {})[name] = value
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m ontime_analytics", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("job", choices=sorted(JOBS) + ["bad-rows", "ingest", "stream-ingest"])
    ap.add_argument("--flights", action="append", help="raw flight files or a typed lake (repeatable)")
    ap.add_argument("--out", required=True, help="output directory (the lake for 'ingest')")
    ap.add_argument("--raw", action="store_true", help="--flights are raw text files")
    ap.add_argument("--header", action="store_true", help="raw files start with a header line")
    ap.add_argument("--master", help="registry MASTER file(s)")
    ap.add_argument("--acftref", help="registry ACFTREF file(s)")
    ap.add_argument("--master-url", help="Spark master, e.g. local[8] (default: from spark-submit)")
    ap.add_argument("--param", action="append", default=[], metavar="QUERY.NAME=VALUE",
                    help="threshold or k of one query (repeatable)")
    ap.add_argument("--parallel", type=int, default=4,
                    help="result writes submitted concurrently (default 4)")
    ap.add_argument("--checkpoint", help="stream-ingest: the stream's checkpoint folder")
    ap.add_argument("--max-files", type=int, help="stream-ingest: files in one micro-batch at most")
    a = ap.parse_args(argv)
    if a.job != "aircraft" and not a.flights:
        raise SystemExit(f"job {a.job!r} needs --flights")
    params = parse_params(a.param)
    spark = get_session(f"ontime_{a.job}", master=a.master_url)
    if a.job == "ingest":
        ingest_flights(spark, a.flights, a.out, header=a.header)
    elif a.job == "stream-ingest":
        if len(a.flights) > 1:
            raise SystemExit("stream-ingest takes one --flights folder")
        start_flight_ingest(spark, a.flights[0], a.out, checkpoint_location=a.checkpoint, header=a.header,
                            max_files_per_trigger=a.max_files).awaitTermination()
    elif a.job == "bad-rows":
        write_json(bad_rows(spark, a.flights, header=a.header), os.path.join(a.out, "bad_rows"), single_file=True)
    else:
        run_job(spark, a.job, a.flights, a.out, raw=a.raw, header=a.header,
                master=a.master, acftref=a.acftref, params=params, parallel=a.parallel)
    return 0


if __name__ == "__main__":
    sys.exit(main())
