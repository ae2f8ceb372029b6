"""Oracle SQL (DuckDB dialect) for every named query, on the fixture.

Used by the driver's correctness check and by ``tests/test_oracle.py``: the
same stand-in rows are built from the registered ``lineitem`` / ``part`` views
(FIXTURES.md B1-B3), typed with the same strict-integer rule, and each query
is written as plain SQL.  Where it can, the SQL states a rule differently from
the Spark code (the distance ladder is spelled out, the crossover days are the
literal list of dates) so the two check each other.
"""

from __future__ import annotations

from ontime_analytics import schema as S
from ontime_analytics.plans.catalog import FIXTURE_PARAMS
from ontime_analytics.plans.history import SQL as HISTORY_SQL
from ontime_analytics.plans.history import STREAM_SQL
from ontime_analytics.plans.stored import SAME_AS

_INT = "CASE WHEN regexp_matches({c}, '^[+-]?[0-9]+$') THEN TRY_CAST({c} AS INTEGER) END"


def _int(c: str) -> str:
    return _INT.format(c=c)


# FIXTURES.md B1 with {DOW} = isodow(l_shipdate)
_FLIGHTS_RAW = """
select cast(year(l_shipdate) as string) as Year, cast(month(l_shipdate) as string) as Month,
 cast(day(l_shipdate) as string) as DayofMonth, cast(isodow(l_shipdate) as string) as DayOfWeek,
 concat('C', cast(l_suppkey % 17 as string)) as UniqueCarrier,
 case when l_linenumber = 6 then 'NA' else concat('N', to_base(l_partkey, 36)) end as TailNum,
 case when l_linenumber = 7 then 'NA'
      else cast(cast(l_quantity as int) * 2 - 50 + cast(l_suppkey % 9 as int) as string) end as ArrDelay,
 case when l_linenumber = 7 and l_linestatus = 'O' then 'NA' when l_linenumber = 7 then ''
      when l_partkey % 97 = 0 then ' 20'
      else cast(cast(l_quantity as int) * 3 - 90 + cast(l_partkey % 31 as int) as string) end as DepDelay,
 concat('A', cast(l_partkey % 120 as string)) as Origin,
 concat('A', cast((l_partkey * 7 + l_suppkey) % 120 as string)) as Dest,
 case when l_linenumber = 5 and l_linestatus = 'F' then 'NA'
      else cast(cast(floor(l_extendedprice / 18) as int) as string) end as Distance,
 case when l_returnflag = 'R' and l_linenumber = 1 then '1' when l_linenumber = 2 then 'x' else '0' end as Cancelled,
 case when l_returnflag = 'R' and l_linenumber = 1
      then case l_suppkey % 5 when 0 then 'A' when 1 then 'b' when 2 then 'C' when 3 then 'D' else 'Z' end
      when l_linestatus = 'O' then 'NA' else '' end as CancellationCode,
 case when year(l_shipdate) < 1998 then 'NA' else cast(cast(l_quantity as int) % 7 as string) end as CarrierDelay,
 case when year(l_shipdate) < 1998 then 'NA' else cast(cast(l_quantity as int) % 5 as string) end as WeatherDelay,
 case when year(l_shipdate) < 1998 then 'NA' else cast(cast(l_partkey % 4 as int) as string) end as NASDelay,
 case when year(l_shipdate) < 1998 then '' else cast(cast(l_suppkey % 3 as int) as string) end as SecurityDelay,
 case when year(l_shipdate) < 1999 then 'NA' else cast(cast(l_partkey % 11 as int) as string) end as LateAircraftDelay, l_orderkey
from lineitem
"""

_FLIGHTS = f"""
select {_int('Year')} as year, {_int('Month')} as month,
 {_int('DayofMonth')} as day_of_month, {_int('DayOfWeek')} as day_of_week,
 UniqueCarrier as carrier, trim(TailNum) as tail_num,
 {_int('ArrDelay')} as arr_delay, {_int('DepDelay')} as dep_delay,
 Origin as origin, {_int('Distance')} as distance,
 coalesce({_int('Cancelled')}, 0) as cancelled,
 coalesce(CancellationCode, '') as cancel_code_raw, upper(CancellationCode) as cancel_code,
 {_int('CarrierDelay')} as carrier_delay, {_int('WeatherDelay')} as weather_delay,
 {_int('NASDelay')} as nas_delay, {_int('SecurityDelay')} as security_delay,
 {_int('LateAircraftDelay')} as late_aircraft_delay, Dest as dest
from flights_raw
"""

# FIXTURES.md B2 / B3, then the fixed-width slices and J1 (one row per tail).
_REGISTRY = """
master_raw as (
 select concat(rpad(to_base(p_partkey, 36), 5, ' '), repeat(' ', 32), lpad(cast(p_size as string), 6, '0')) as value
 from part where p_partkey % 10 <> 0),
acftref_raw as (
 select distinct concat(lpad(cast(p_size as string), 6, '0'), repeat(' ', 33),
  rpad(concat('MODEL-', cast(p_size as string)), 19, ' ')) as value
 from part where p_size % 13 <> 0),
master as (select trim(substring(value, 1, 5)) as tail, substring(value, 38, 6) as mfr_model_code from master_raw),
acftref as (select substring(value, 1, 6) as mfr_model_code, trim(substring(value, 40, 19)) as model from acftref_raw),
aircraft as (
 select tail, max({'model': model, 'code': mfr_model_code}).code as mfr_model_code,
        max({'model': model, 'code': mfr_model_code}).model as model
 from master join acftref using (mfr_model_code) group by tail)
"""

# --- fixed values: the 44 US daylight-saving crossover dates, 1987-2008 ---
_DST_DATES = """
(1987,4,5),(1987,10,25),(1988,4,3),(1988,10,30),(1989,4,2),(1989,10,29),
(1990,4,1),(1990,10,28),(1991,4,7),(1991,10,27),(1992,4,5),(1992,10,25),
(1993,4,4),(1993,10,31),(1994,4,3),(1994,10,30),(1995,4,2),(1995,10,29),
(1996,4,7),(1996,10,27),(1997,4,6),(1997,10,26),(1998,4,5),(1998,10,25),
(1999,4,4),(1999,10,31),(2000,4,2),(2000,10,29),(2001,4,1),(2001,10,28),
(2002,4,7),(2002,10,27),(2003,4,6),(2003,10,26),(2004,4,4),(2004,10,31),
(2005,4,3),(2005,10,30),(2006,4,2),(2006,10,29),(2007,3,11),(2007,11,4),
(2008,3,9),(2008,11,2)
"""

_PREFIX = (f"with flights_raw as ({_FLIGHTS_RAW}),\nflights as ({_FLIGHTS}),\n{_REGISTRY},\n"
           f"dst_days(year, month, day_of_month) as (values {_DST_DATES})\n")

DELAYED = "coalesce(dep_delay > 15, false)"
TAIL_KEY = ("case when tail_num <> 'NA' and length(tail_num) >= 2 and starts_with(tail_num, 'N') "
            "then substr(tail_num, 2) else tail_num end")
DAY_NAME = ("case day_of_week when 1 then 'Monday' when 2 then 'Tuesday' when 3 then 'Wednesday' "
            "when 4 then 'Thursday' when 5 then 'Friday' when 6 then 'Saturday' "
            "when 7 then 'Sunday' end")
MONTH_NAME = ("case month when 1 then 'January' when 2 then 'February' when 3 then 'March' "
              "when 4 then 'April' when 5 then 'May' when 6 then 'June' when 7 then 'July' "
              "when 8 then 'August' when 9 then 'September' when 10 then 'October' "
              "when 11 then 'November' when 12 then 'December' end")
REASON = ("case upper(cancel_code) when 'A' then 'Carrier' when 'B' then 'Weather' "
          "when 'C' then 'NAS' when 'D' then 'Security' when 'NA' then 'Not Available' end")
BAND = ("case when distance is null or distance < 0 then 'NA' "
        "when distance <= 500 then '0-500' when distance <= 1000 then '501-1000' "
        "when distance <= 1500 then '1001-1500' when distance <= 2000 then '1501-2000' "
        "when distance <= 2500 then '2001-2500' when distance <= 3000 then '2501-3000' "
        "when distance <= 3500 then '3001-3500' when distance <= 4000 then '3501-4000' "
        "when distance <= 4500 then '4001-4500' when distance <= 5000 then '4501-5000' "
        "else '> 5000' end")


def _pct(part: str, whole: str) -> str:
    return f"cast({part} as double) * cast(100 as double) / cast({whole} as double)"


def _cnt(cond: str) -> str:
    return f"cast(sum(case when {cond} then 1 else 0 end) as bigint)"


_AIRPORT_COUNT = f"select origin, count(*) as delayed_flights from flights where {DELAYED} group by origin"
_AIRPORT_PCT = (f"select origin, {_pct(_cnt(DELAYED), 'count(*)')} as delay_percent "
                "from flights where dep_delay is not null group by origin")
_MODEL_JOIN = f"flights f left join aircraft a on a.tail = ({TAIL_KEY})"
_MODEL_COUNT = (f"select coalesce(a.model, 'Unavailable') as model, count(*) as delayed_flights "
                f"from {_MODEL_JOIN} where {DELAYED} and f.tail_num <> 'NA' group by 1")
_MODEL_AVG = ("select coalesce(a.model, 'Unavailable') as model, "
              "cast(sum(f.dep_delay) // count(*) as double) as avg_delay_trunc, "
              "cast(sum(f.dep_delay) as double) / cast(count(*) as double) as avg_delay "
              f"from {_MODEL_JOIN} where {DELAYED} and f.tail_num <> 'NA' group by 1")
_MODEL_PCT = (f"select coalesce(a.model, 'Unavailable') as model, "
              f"{_pct(_cnt(DELAYED), 'count(*)')} as delay_percent "
              f"from {_MODEL_JOIN} where f.dep_delay is not null group by 1")


def _top(sql: str, col: str, key: str, k: int, desc: bool) -> str:
    d = "desc nulls last" if desc else "asc nulls last"
    return f"select * from ({sql}) t order by {col} {d}, {key} asc nulls first limit {k}"


def _reasons_union(select_for) -> str:
    cols = [("Carrier Delay", "carrier_delay"), ("Weather Delay", "weather_delay"),
            ("NAS Delay", "nas_delay"), ("Security Delay", "security_delay"),
            ("Late Aircraft Delay", "late_aircraft_delay")]
    return "\nunion all\n".join(select_for(label, c) for label, c in cols)


def _bodies() -> dict[str, str]:
    p = FIXTURE_PARAMS
    avg_cols = ("cast(sum(dep_delay) // count(*) as double) as avg_delay_trunc, "
                "cast(sum(dep_delay) as double) / cast(count(*) as double) as avg_delay")
    dst = "flights join dst_days using (year, month, day_of_month)"
    b = {
        "delay_by_year": (
            "select year, cast(sum(case when dep_delay > 15 then dep_delay else 0 end) as bigint) "
            "as delay_minutes, count(*) as flights from flights group by year"),
        "delays_by_day_of_week": (
            f"select {DAY_NAME} as day_name, {_cnt(DELAYED)} as delayed_flights from flights group by 1"),
        "delays_by_day_of_month": (
            f"select day_of_month, {_cnt(DELAYED)} as delayed_flights from flights group by day_of_month"),
        "delays_by_month": (
            f"select {MONTH_NAME} as month_name, {_cnt(DELAYED)} as delayed_flights from flights group by 1"),
        "net_delay_by_day_of_week": (
            "select day_of_week, count(*) as flights from flights "
            "where cast(arr_delay as bigint) + cast(dep_delay as bigint) > 0 group by day_of_week"),
        "airport_delay_count": f"{_AIRPORT_COUNT} order by delayed_flights, origin",
        "airport_delay_count_upper": (
            f"select * from ({_AIRPORT_COUNT}) t "
            f"where delayed_flights >= {p['airport_delay_count_upper']['min_count']}"),
        "airport_delay_count_lower": (
            f"select * from ({_AIRPORT_COUNT}) t "
            f"where delayed_flights <= {p['airport_delay_count_lower']['max_count']}"),
        "airport_average_delay": (
            f"select origin, {avg_cols} from flights where {DELAYED} group by origin"),
        "airport_delay_percent": f"{_AIRPORT_PCT} order by delay_percent, origin",
        "airport_delay_percent_upper": (
            f"select * from ({_AIRPORT_PCT}) t "
            f"where delay_percent >= {p['airport_delay_percent_upper']['min_pct']}"),
        "airport_delay_percent_lower": (
            f"select * from ({_AIRPORT_PCT}) t "
            f"where delay_percent <= {p['airport_delay_percent_lower']['max_pct']}"),
        "airport_count_top": _top(_AIRPORT_COUNT, "delayed_flights", "origin",
                                  p["airport_count_top"]["k"], True),
        "airport_count_bottom": _top(_AIRPORT_COUNT, "delayed_flights", "origin",
                                     p["airport_count_bottom"]["k"], False),
        "airport_percent_top": _top(_AIRPORT_PCT, "delay_percent", "origin",
                                    p["airport_percent_top"]["k"], True),
        "airport_percent_bottom": _top(_AIRPORT_PCT, "delay_percent", "origin",
                                       p["airport_percent_bottom"]["k"], False),
        "dst_average_delay": f"select year, {avg_cols} from {dst} where {DELAYED} group by year",
        "dst_delay_percent": (
            f"select year, {_pct(_cnt(DELAYED), 'count(*)')} as delay_percent "
            f"from {dst} where dep_delay is not null group by year"),
        "aircraft_dim": "select tail, mfr_model_code, model from aircraft",
        "model_delay_count": _MODEL_COUNT,
        "model_delay_count_upper": (
            f"select * from ({_MODEL_COUNT}) t "
            f"where delayed_flights >= {p['model_delay_count_upper']['min_count']}"),
        "model_average_delay": _MODEL_AVG,
        "model_average_delay_upper": (
            f"select * from ({_MODEL_AVG}) t "
            f"where avg_delay_trunc >= {p['model_average_delay_upper']['min_avg']}"),
        "model_delay_percent": _MODEL_PCT,
        "model_delay_percent_upper": (
            f"select * from ({_MODEL_PCT}) t "
            f"where delay_percent >= {p['model_delay_percent_upper']['min_pct']}"),
        "cancellations_by_reason": (
            f"select {REASON} as reason, count(*) as flights from flights where cancelled = 1 group by 1 "
            "union all select 'All Flights' as reason, count(*) as flights from flights"),
        "cancellations_by_month_reason": (
            f"select year, month, {REASON} as reason, count(*) as flights from flights "
            "where cancelled = 1 group by all"),
        "cancellations_by_carrier": (
            f"select carrier, count(*) as flights, {_cnt('cancelled = 1')} as cancelled_flights "
            "from flights group by carrier"),
        "cancellation_code_counts": (
            "select cancel_code_raw, count(*) as flights from flights group by cancel_code_raw"),
        "delay_reason_counts": _reasons_union(
            lambda label, c: f"select '{label}' as reason, {_cnt(f'{c} > 0')} as flights from flights"),
        "delay_reason_minutes": _reasons_union(
            lambda label, c: (
                f"select '{label}' as reason, cast(coalesce(sum({c}), 0) as bigint) as minutes, "
                f"count({c}) as flights, case when count({c}) > 0 then "
                f"cast(sum({c}) as double) / cast(count({c}) as double) end as avg_minutes from flights")),
        "distance_impact": (
            f"select {BAND} as distance_band, count(*) as flights, "
            f"{_cnt('cancelled = 1')} as cancelled_flights, {_cnt(DELAYED)} as delayed_flights "
            "from flights group by 1"),
        "monthly_airlines_delays": (
            "select year, month, count(*) as flights, count(distinct carrier) as airlines, "
            f"{_cnt(DELAYED)} as delayed_flights from flights group by year, month"),
        "flights_delays_by_model": (
            f"select a.model as model, count(*) as flights, {_cnt(DELAYED)} as delayed_flights "
            f"from flights f join aircraft a on a.tail = ({TAIL_KEY}) group by a.model"),
        "delays_by_model_all": (
            f"select coalesce(a.model, 'Unavailable') as model, {_cnt(DELAYED)} as delayed_flights "
            f"from {_MODEL_JOIN} group by 1"),
        "model_count_top": _top(_MODEL_COUNT, "delayed_flights", "model",
                                p["model_count_top"]["k"], True),
        "model_count_bottom": _top(_MODEL_COUNT, "delayed_flights", "model",
                                   p["model_count_bottom"]["k"], False),
        "model_average_top": _top(_MODEL_AVG, "avg_delay_trunc", "model",
                                  p["model_average_top"]["k"], True),
        "model_percent_top": _top(_MODEL_PCT, "delay_percent", "model",
                                  p["model_percent_top"]["k"], True),
    }
    return b


# FIXTURES.md B4, then DuckDB's own split; a field that a short line lacks is NULL
_GIVEN = ("Year", "Month", "DayofMonth", "DayOfWeek", "UniqueCarrier", "TailNum", "ArrDelay", "DepDelay", "Origin", "Dest", "Distance",
          "Cancelled", "CancellationCode", "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay")
_FIELDS = [c if c in _GIVEN else "''" for c in S.RAW_COLUMNS]
_LINES = f"""
with flights_raw as ({_FLIGHTS_RAW}),
lines as (select case l_orderkey % 10 when 0 then concat_ws(',', {', '.join(_FIELDS[:16])})
 when 1 then concat_ws(',', {', '.join(_FIELDS)}, 'more') else concat_ws(',', {', '.join(_FIELDS)}) end as value from flights_raw),
f as (select string_split(value, ',') as a from lines)
"""


def _field(raw: str) -> str:
    return f"a[{S.RAW_COLUMNS.index(raw) + 1}]"


def _line_bodies() -> dict[str, str]:
    n = lambda c: _int(_field(c))
    unparsable = ", ".join(f"count(*) filter ({n(raw)} is null and not coalesce({_field(raw)} = 'NA', false)) as unparsable_{typed}"
                           for raw, typed in S.INT_FIELDS)
    return {
        "parsed_line_totals": f"""
select {n('Year')} as year, coalesce({_field('CancellationCode')}, '') as cancel_code_raw, count(*) as flights,
 cast(sum({n('DepDelay')}) as bigint) as dep_delay_minutes, count({n('ArrDelay')}) as timed_arrivals,
 cast(sum({n('Distance')}) as bigint) as miles, count(*) filter (trim({_field('TailNum')}) = 'NA') as unknown_tails,
 cast(sum(coalesce({n('Cancelled')}, 0)) as bigint) as cancelled_flights,
 cast(sum({n('LateAircraftDelay')}) as bigint) as late_aircraft_minutes, count({_field('UniqueCarrier')}) as with_carrier
from f group by 1, 2""",
        "ingested_lake_totals": f"""
select {n('Year')} as year, count(*) as flights, cast(sum({n('DepDelay')}) as bigint) as dep_delay_minutes, cast(sum({n('Distance')}) as bigint) as miles
from f group by 1""",
        "streamed_distinct_lines": f"""
select {n('Year')} as year, count(*) as lines from (select distinct a from f) group by 1""",
        "bad_rows": f"""
select count(*) as rows, count(*) filter (len(a) <> {len(S.RAW_COLUMNS)}) as wrong_field_count, {unparsable} from f""",
    }


def oracle_sql() -> dict[str, str]:
    """name -> complete DuckDB statement over the registered driver views."""
    return {**{name: _PREFIX + body for name, body in _bodies().items()},
            **{name: _PREFIX + body for name, body in (HISTORY_SQL | STREAM_SQL).items()},
            **{name: _PREFIX + _bodies()[same] for name, same in SAME_AS.items()},
            **{name: _LINES + body for name, body in _line_bodies().items()}}
