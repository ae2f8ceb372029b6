"""Brute force: random dirty raw lines through the library's reader, typing
and analyses, against plain-Python implementations of the same semantics."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest

from ontime_analytics import schema as S
from ontime_analytics.operators.aircraft import ModelJoin, aircraft_dimension
from ontime_analytics.plans.catalog import build
from ontime_analytics.sources.flights import parse_flight_lines, type_flights
from ontime_analytics.sources.registry import parse_model_lookup, parse_registry_master

N_LINES = 3000
COL = {c: i for i, c in enumerate(S.RAW_COLUMNS)}


def jint(s):
    """Java Integer.parseInt on ASCII digits; None when it would throw."""
    if s is None or s == "":
        return None
    body = s[1:] if s[0] in "+-" else s
    if not body or not body.isascii() or not body.isdigit():
        return None
    v = int(s)
    return v if -(2**31) <= v < 2**31 else None


def random_lines(seed=7):
    r = random.Random(seed)
    delay = lambda: r.choice([str(r.randint(-40, 240)), str(r.randint(10, 20)), "NA", "", " 20",
                              "5.7", "+16", "16 ", "-0"])
    pools = {
        "Year": lambda: r.choice(["1987", "1988", "1996", "2006", "2007", "2008", "NA", " 1990"]),
        "Month": lambda: r.choice([str(m) for m in range(1, 13)] * 3 + ["13", "x", "3", "4", "10", "11"]),
        "DayofMonth": lambda: str(r.choice(list(range(1, 32)) + [2, 3, 4, 5, 9, 11, 25, 30, 31])),
        "DayOfWeek": lambda: r.choice([str(d) for d in range(1, 8)] + ["8", "NA"]),
        "UniqueCarrier": lambda: r.choice(["AA", "UA", "DL", "WN", ""]),
        "TailNum": lambda: r.choice(["N123", "N45", "NA", "N", "N12NN", " N999 ", "123", "", "N678", "NN45"]),
        "ArrDelay": delay,
        "DepDelay": delay,
        "Origin": lambda: r.choice(["ORD", "ATL", "LAX", "SFO", ""]),
        "Distance": lambda: r.choice([str(r.randint(0, 6000)), "0", "500", "501", "5000", "5001", "-1",
                                      "NA", "abc"]),
        "Cancelled": lambda: r.choice(["0", "0", "0", "1", "1", " 1", "x", ""]),
        "CancellationCode": lambda: r.choice(["A", "b", "C", "d", "NA", "Z", "", "NA "]),
    }
    for c in ("CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"):
        pools[c] = lambda: r.choice(["0", "5", "-2", "NA", "", " 3", str(r.randint(0, 90))])
    lines = []
    for _ in range(N_LINES):
        f = [pools[c]() if c in pools else "x" for c in S.RAW_COLUMNS]
        if r.random() < 0.02:
            f = f[: r.randint(1, 28)]  # short line
        lines.append(",".join(f))
    return lines


def fields(line):
    f = line.split(",")
    return {c: (f[i] if i < len(f) else None) for c, i in COL.items()}


def rows(lines):
    out = []
    for line in lines:
        f = fields(line)
        tail = f["TailNum"].strip(" ") if f["TailNum"] is not None else None
        out.append(dict(
            year=jint(f["Year"]), month=jint(f["Month"]), dom=jint(f["DayofMonth"]),
            dow=jint(f["DayOfWeek"]), carrier=f["UniqueCarrier"], tail=tail,
            arr=jint(f["ArrDelay"]), dep=jint(f["DepDelay"]), origin=f["Origin"],
            dist=jint(f["Distance"]), cancelled=jint(f["Cancelled"]) or 0,
            code_raw=f["CancellationCode"] if f["CancellationCode"] is not None else "",
            code=f["CancellationCode"].upper() if f["CancellationCode"] is not None else None,
            reasons={label: jint(f[raw]) for label, raw in (
                ("Carrier Delay", "CarrierDelay"), ("Weather Delay", "WeatherDelay"),
                ("NAS Delay", "NASDelay"), ("Security Delay", "SecurityDelay"),
                ("Late Aircraft Delay", "LateAircraftDelay"))}))
    return out


def delayed(x):
    return x["dep"] is not None and x["dep"] > 15


def band(d):
    if d is None or d < 0:
        return "NA"
    for hi in range(500, 5001, 500):
        if d <= hi:
            return f"{hi - 499 if hi > 500 else 0}-{hi}"
    return "> 5000"


def dst_days():
    days = set()
    for y in range(1987, 2009):
        def sundays(m):
            d = dt.date(y, m, 1)
            return [d + dt.timedelta(i) for i in range(31)
                    if (d + dt.timedelta(i)).month == m and (d + dt.timedelta(i)).weekday() == 6]
        pair = (sundays(4)[0], sundays(10)[-1]) if y <= 2006 else (sundays(3)[1], sundays(11)[0])
        days |= {(p.year, p.month, p.day) for p in pair}
    return days


REASON = {"A": "Carrier", "B": "Weather", "C": "NAS", "D": "Security", "NA": "Not Available"}
REGISTRY = {"123": "B737", "45": "A320", "12NN": "B737", "678": "E190"}


def tail_key(t):
    if t is not None and t != "NA" and len(t) >= 2 and t[0] == "N":
        return t[1:]
    return t


def expected(name, data):
    g = defaultdict(lambda: defaultdict(int))
    if name == "delay_by_year":
        for x in data:
            g[x["year"]]["m"] += x["dep"] if delayed(x) else 0
            g[x["year"]]["n"] += 1
        return {(k, v["m"], v["n"]) for k, v in g.items()}
    if name == "delays_by_month":
        names = dict(enumerate(S.MONTH_NAMES, 1))
        for x in data:
            g[names.get(x["month"])]["d"] += delayed(x)
        return {(k, v["d"]) for k, v in g.items()}
    if name == "net_delay_by_day_of_week":
        for x in data:
            if x["arr"] is not None and x["dep"] is not None and x["arr"] + x["dep"] > 0:
                g[x["dow"]]["n"] += 1
        return {(k, v["n"]) for k, v in g.items()}
    if name == "airport_average_delay":
        for x in data:
            if delayed(x):
                g[x["origin"]]["t"] += x["dep"]
                g[x["origin"]]["n"] += 1
        return {(k, float(v["t"] // v["n"]), v["t"] / v["n"]) for k, v in g.items()}
    if name == "airport_delay_percent":
        for x in data:
            if x["dep"] is not None:
                g[x["origin"]]["d"] += delayed(x)
                g[x["origin"]]["n"] += 1
        return {(k, v["d"] * 100.0 / v["n"]) for k, v in g.items()}
    if name == "dst_delay_percent":
        days = dst_days()
        for x in data:
            if (x["year"], x["month"], x["dom"]) in days and x["dep"] is not None:
                g[x["year"]]["d"] += delayed(x)
                g[x["year"]]["n"] += 1
        return {(k, v["d"] * 100.0 / v["n"]) for k, v in g.items()}
    if name == "cancellations_by_reason":
        for x in data:
            g["All Flights"]["n"] += 1
            if x["cancelled"] == 1:
                g[REASON.get(x["code"]) if x["code"] is not None else None]["n"] += 1
        return {(k, v["n"]) for k, v in g.items()}
    if name == "cancellation_code_counts":
        for x in data:
            g[x["code_raw"]]["n"] += 1
        return {(k, v["n"]) for k, v in g.items()}
    if name == "delay_reason_minutes":
        for x in data:
            for label, v in x["reasons"].items():
                g[label]["m"] += v or 0
                g[label]["n"] += v is not None
        return {(k, v["m"], v["n"], (v["m"] / v["n"]) if v["n"] else None) for k, v in g.items()}
    if name == "distance_impact":
        for x in data:
            b = g[band(x["dist"])]
            b["n"] += 1
            b["c"] += x["cancelled"] == 1
            b["d"] += delayed(x)
        return {(k, v["n"], v["c"], v["d"]) for k, v in g.items()}
    if name == "monthly_airlines_delays":
        carriers = defaultdict(set)
        for x in data:
            k = (x["year"], x["month"])
            g[k]["n"] += 1
            g[k]["d"] += delayed(x)
            if x["carrier"] is not None:
                carriers[k].add(x["carrier"])
        return {(k[0], k[1], v["n"], len(carriers[k]), v["d"]) for k, v in g.items()}
    if name == "model_delay_percent":
        for x in data:
            if x["dep"] is not None:
                m = REGISTRY.get(tail_key(x["tail"]), "Unavailable")
                g[m]["d"] += delayed(x)
                g[m]["n"] += 1
        return {(k, v["d"] * 100.0 / v["n"]) for k, v in g.items()}
    if name == "model_delay_count":
        for x in data:
            if delayed(x) and x["tail"] is not None and x["tail"] != "NA":
                g[REGISTRY.get(tail_key(x["tail"]), "Unavailable")]["n"] += 1
        return {(k, v["n"]) for k, v in g.items()}
    if name == "flights_delays_by_model":
        for x in data:
            m = REGISTRY.get(tail_key(x["tail"]))
            if m is not None:
                g[m]["n"] += 1
                g[m]["d"] += delayed(x)
        return {(k, v["n"], v["d"]) for k, v in g.items()}
    raise KeyError(name)


COLUMNS = {
    "delay_by_year": ["year", "delay_minutes", "flights"],
    "delays_by_month": ["month_name", "delayed_flights"],
    "net_delay_by_day_of_week": ["day_of_week", "flights"],
    "airport_average_delay": ["origin", "avg_delay_trunc", "avg_delay"],
    "airport_delay_percent": ["origin", "delay_percent"],
    "dst_delay_percent": ["year", "delay_percent"],
    "cancellations_by_reason": ["reason", "flights"],
    "cancellation_code_counts": ["cancel_code_raw", "flights"],
    "delay_reason_minutes": ["reason", "minutes", "flights", "avg_minutes"],
    "distance_impact": ["distance_band", "flights", "cancelled_flights", "delayed_flights"],
    "monthly_airlines_delays": ["year", "month", "flights", "airlines", "delayed_flights"],
    "model_delay_percent": ["model", "delay_percent"],
    "model_delay_count": ["model", "delayed_flights"],
    "flights_delays_by_model": ["model", "flights", "delayed_flights"],
}


@pytest.fixture(scope="module")
def inputs(spark):
    lines = random_lines()
    fl = type_flights(parse_flight_lines(spark.createDataFrame([(x,) for x in lines], "value string")))
    pad = " " * 32
    master = spark.createDataFrame([(f"{t:<5}{pad}{c}",) for t, c in
                                    [("123", "000001"), ("45", "000002"), ("12NN", "000001"),
                                     ("678", "000003"), ("999", "000404")]], "value string")
    lookup = spark.createDataFrame([(f"{c}{' ' * 33}{m:<19}",) for c, m in
                                    [("000001", "B737"), ("000002", "A320"), ("000003", "E190")]],
                                   "value string")
    aircraft = aircraft_dimension(parse_registry_master(master), parse_model_lookup(lookup))
    return fl, aircraft, rows(lines)


CASES = [(n, None) for n in sorted(COLUMNS) if not n.startswith(("model", "flights_"))] + \
    [(n, s) for n in sorted(COLUMNS) if n.startswith(("model", "flights_")) for s in ("broadcast", "shuffle")]


@pytest.mark.parametrize("name,strategy", CASES)
def test_against_brute_force(inputs, name, strategy):
    fl, aircraft, data = inputs
    kw = {"join": ModelJoin(strategy=strategy)} if strategy else {}
    got = {tuple(r[c] for c in COLUMNS[name]) for r in build(name, fl, aircraft, **kw).collect()}
    assert got == expected(name, data)


def _summary_cases():
    from ontime_analytics.plans.catalog import SUMMARIES

    return [(kind, n) for kind, s in SUMMARIES.items() for n in s.views if n in COLUMNS]


@pytest.mark.parametrize("kind,name", _summary_cases())
def test_job_summary_views_against_brute_force(inputs, kind, name):
    """The views the job runner derives from a shared summary, on dirty data."""
    from ontime_analytics.plans.catalog import SUMMARIES

    fl, aircraft, data = inputs
    s = SUMMARIES[kind]
    summary = s.make(fl, aircraft, ModelJoin()) if s.needs_aircraft else s.make(fl)
    got = {tuple(r[c] for c in COLUMNS[name]) for r in s.views[name](summary).collect()}
    assert got == expected(name, data)
