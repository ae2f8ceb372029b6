"""Further named queries: joins in time, runs, ranks, subtotals, quantiles and set comparisons over the flights.

The published programs have none of these; they answer what those leave open
(does a late aircraft stay late, how long do bad days last, ...).  Entries
are like those of :mod:`.catalog`, which adds them to what ``build`` knows.
:data:`SQL` holds the DuckDB bodies, over the tables that :mod:`.oracle` derives.
"""

from __future__ import annotations

from ontime_analytics.operators import asof, cancellations, coverage, cubes, delays, intervals, quantiles, ranks, routes, sketches, streaks

#: name -> (function, needs the aircraft dimension, result stays small as the input grows)
HISTORY = {
    "previous_departures": (asof.previous_departures, False, False),
    "previous_departure_impact": (asof.previous_departure_impact, False, True),
    "holiday_window_delays": (intervals.holiday_window_delays, False, True),
    "airport_rank_by_month": (ranks.airport_rank_by_month, False, False),
    "worst_departures_by_month": (ranks.worst_departures_by_month, False, False),
    "carrier_running_delay": (ranks.carrier_running_delay, False, False),
    "airport_delay_streaks": (streaks.airport_delay_streaks, False, False),
    "streaks_in_windows": (streaks.streaks_in_windows, False, True),
    "delay_cube": (cubes.delay_cube, False, False),
    "calendar_rollup": (cubes.calendar_rollup, False, False),
    "carrier_sets": (cubes.carrier_sets, False, True),
    "airport_delay_quantiles": (quantiles.airport_delay_quantiles, False, True),
    "carrier_year_delay_quantiles": (quantiles.carrier_year_delay_quantiles, False, True),
    "carrier_year_tails": (sketches.carrier_year_tails, False, True),
    "unregistered_tails": (coverage.unregistered_tails, True, False),
    "tail_sets": (coverage.tail_sets, True, True),
    "route_changes": (coverage.route_changes, False, True),
    "cancellations_by_day": (cancellations.cancellations_by_day, False, True),
    "delay_percent_by_year": (delays.delay_percent_by_year, False, True),
    "destination_delays": (routes.destination_delays, False, True),
    "route_delays": (routes.route_delays, False, False),
    "airport_traffic": (routes.airport_traffic, False, True),
    "merger_impact": (routes.merger_impact, False, True),
}

#: Parameters that select something on the fixture, whose carriers are C0 to C16.
PARAMS = {
    "route_delays": {"min_flights": 8},
    "merger_impact": {"mergers": (("C3", "C5", 1997, 6, 1), ("C16", "C0", 1996, 2, 29), ("C1", "XX", 1995, 1, 20)), "days": 90},
}

_DELAYED = "coalesce(dep_delay > 15, false)"
_DAY = "make_date(year, month, day_of_month)"
_PERCENT = "cast(sum(delayed) as double) * cast(100 as double) / cast(sum(n) as double) as delay_percent"
_TAIL = ("case when tail_num <> 'NA' then case when length(tail_num) >= 2 and starts_with(tail_num, 'N') "
         "then substr(tail_num, 2) else tail_num end end")
_LEGS = f", legs as (select *, {_TAIL} as tail, {_DAY} as day from flights)"
_WINDOWS = ", ".join(f"('{n}', {a}, {b}, {c}, {d})" for n, a, b, c, d in intervals.WINDOWS)
_CALENDAR = f""", bounds as (select min(year) - 1 as a, max(year) as z from flights),
names(name, m1, d1, m2, d2) as (values {_WINDOWS}),
years as (select cast(unnest(generate_series(a, z)) as integer) as y from bounds),
spans as (select name as "window", y as window_year, make_date(y, m1, d1) as a,
 make_date(case when m2 * 100 + d2 < m1 * 100 + d1 then y + 1 else y end, m2, d2) as z from names cross join years)"""
_STREAKS = f""", bad as (select origin, {_DAY} as day, count(*) as n, count(*) filter ({_DELAYED}) as delayed from flights
 group by origin, year, month, day_of_month having count(*) filter ({_DELAYED}) * 100 >= count(*) * 50.0),
marked as (select *, day - cast(row_number() over (partition by origin order by day) as integer) as island from bad),
streaks as (select origin, min(day) as a, max(day) as z, count(*) as days, cast(sum(n) as bigint) as flights, cast(sum(delayed) as bigint) as delayed_flights
 from marked group by origin, island having count(*) >= 2)"""
_SUMS = ("cast(sum(n) as bigint) as flights, cast(sum(delayed) as bigint) as delayed_flights, cast(sum(cancelled_n) as bigint) as cancelled_flights, "
         f"cast(sum(minutes) as bigint) as delay_minutes, {_PERCENT}")
_ROWS = (f", r as (select *, 1 as n, case when {_DELAYED} then 1 else 0 end as delayed, case when cancelled = 1 then 1 else 0 end as cancelled_n, "
         f"case when {_DELAYED} then dep_delay else 0 end as minutes from flights)")


def _quantiles(by: str) -> str:
    at = ", ".join(f"min(case when nth >= greatest((total * {share} + 999) // 1000, 1) then v end) as {name}" for name, share in quantiles.SHARES.items())
    return (f", q as (select {by}, cast(dep_delay as bigint) as v, row_number() over (partition by {by} order by dep_delay) as nth, "
            f"count(*) over (partition by {by}) as total from flights where dep_delay is not null)\n"
            f"select {by}, count(*) as rows, {at}, median(v) as median from q group by {by}")


#: name -> what follows the common tables of the oracle (``with flights_raw ..., flights ..., aircraft ...``)
SQL = {
    "previous_departures": _LEGS + """,
given as (select tail, day, dep_delay, origin from legs where tail is not null
 qualify row_number() over (partition by tail, day order by dep_delay desc nulls last, origin desc nulls last) = 1)
select l.year, l.month, l.day_of_month, l.tail, l.origin, l.dep_delay, cast(date_diff('day', g.day, l.day) as integer) as days_since,
 g.origin as previous_origin, g.dep_delay as previous_delay
from legs l asof left join given g on l.tail = g.tail and l.day > g.day""",
    "previous_departure_impact": _LEGS + f""",
daily as (select tail, day, count(*) as n, count(*) filter ({_DELAYED}) as delayed, max(dep_delay) as worst from legs group by tail, day),
follow as (select *, date_diff('day', lag(day) over w, day) as gap, lag(worst) over w as before from daily where tail is not null window w as (partition by tail order by day)),
every as (select n, delayed, gap, before from follow union all select n, delayed, null, null from daily where tail is null)
select case when gap = 1 then 'the day before' when gap <= 7 then '2 to 7 days' when gap <= 30 then '8 to 30 days' when gap > 30 then 'longer' else 'none known' end as last_flown,
 case when gap is not null then coalesce(before > 15, false) end as was_delayed,
 cast(sum(n) as bigint) as flights, cast(sum(delayed) as bigint) as delayed_flights, {_PERCENT} from every group by 1, 2""",
    "holiday_window_delays": _CALENDAR + f"""
select "window", window_year, count(*) as flights, count(*) filter ({_DELAYED}) as delayed_flights, count(*) filter (cancelled = 1) as cancelled_flights,
 cast(count(*) filter ({_DELAYED}) as double) * cast(100 as double) / cast(count(*) as double) as delay_percent
from flights join spans on {_DAY} between a and z group by all""",
    "airport_rank_by_month": f""", m as (select year, month, origin, count(*) as flights, count(*) filter ({_DELAYED}) as delayed_flights,
 cast(count(*) filter ({_DELAYED}) as double) * cast(100 as double) / cast(count(*) as double) as delay_percent from flights where dep_delay is not null group by all),
p as (select *, cast(row_number() over w as integer) as place, cast(ntile(4) over w as integer) as quartile from m
 window w as (partition by year, month order by delay_percent desc, origin))
select *, place - lag(place) over (partition by origin order by year, month) as moved from p""",
    "worst_departures_by_month": """
select year, month, rank() over w as rank, dense_rank() over w as dense_rank, day_of_month, carrier, tail_num, origin, dep_delay
from flights where dep_delay is not null window w as (partition by year, month order by dep_delay desc) qualify rank() over w <= 5""",
    "carrier_running_delay": f""", d as (select carrier, year, month, day_of_month, {_DAY} as day, cast(sum(dep_delay) as bigint) as minutes
 from flights where {_DELAYED} group by all)
select carrier, year, month, day_of_month, minutes, cast(sum(minutes) over (partition by carrier order by day) as bigint) as minutes_so_far,
 cast(sum(minutes) over (partition by carrier order by day range between interval 27 days preceding and current row) as bigint) as recent_minutes from d""",
    "airport_delay_streaks": _STREAKS + """
select origin, cast(a as string) as first_day, cast(z as string) as last_day, days, flights, delayed_flights from streaks""",
    "streaks_in_windows": _CALENDAR + _STREAKS.replace("min(day) as a, max(day) as z", "min(day) as b, max(day) as y") + """
select "window", window_year, count(*) as streaks, count(distinct origin) as airports,
 cast(sum(date_diff('day', greatest(b, a), least(streaks.y, z)) + 1) as bigint) as shared_days
from streaks join spans on b <= z and streaks.y >= a group by all""",
    "delay_cube": _ROWS + f"""
select carrier, origin, month, cast(grouping(carrier, origin, month) as integer) as level, {_SUMS} from r group by cube (carrier, origin, month)""",
    "calendar_rollup": _ROWS + f"""
select year, month, day_of_month, cast(grouping(year, month, day_of_month) as integer) as level, {_SUMS} from r group by rollup (year, month, day_of_month)""",
    "carrier_sets": _ROWS + f"""
select carrier, year, day_of_week, cast(grouping(carrier, year, day_of_week) as integer) as level, {_SUMS} from r
group by grouping sets ((carrier, year), (carrier, day_of_week), (year, day_of_week))""",
    "airport_delay_quantiles": _quantiles("origin"),
    "carrier_year_delay_quantiles": _quantiles("carrier, year"),
    "carrier_year_tails": """
select carrier, year, count(distinct tail_num) as tails, true as within_bound from flights where tail_num <> 'NA' group by carrier, year""",
    "unregistered_tails": _LEGS + """
select tail, count(*) as flights from legs where tail is not null and tail not in (select tail from aircraft) group by tail""",
    "tail_sets": _LEGS + f""", s as (
 select distinct l.tail as flown, a.tail as known from (select distinct tail from legs where tail is not null) l full outer join aircraft a on l.tail = a.tail)
select case when flown is null then '{coverage.RIGHT_ONLY}' when known is null then '{coverage.LEFT_ONLY}' else '{coverage.BOTH}' end as status, count(*) as tails
from s group by 1""",
    "route_changes": """, p as (select distinct year * 12 + month - 1 as at_month, carrier, origin from flights),
j as (select coalesce(p.at_month, q.at_month + 1) as m, p.at_month as now, q.at_month as then_month from p full outer join p q
 on p.at_month = q.at_month + 1 and p.carrier = q.carrier and p.origin = q.origin)
select cast(m // 12 as integer) as year, cast(m % 12 + 1 as integer) as month, count(*) filter (then_month is null) as gained,
 count(*) filter (now is null) as lost, count(*) filter (now is not null and then_month is not null) as kept
from j where m in (select at_month from p) and m - 1 in (select at_month from p) group by m""",
    "cancellations_by_day": """
select year, month, day_of_month, count(*) as flights, count(*) filter (cancelled = 1) as cancelled_flights,
 cast(count(*) filter (cancelled = 1) as double) * cast(100 as double) / cast(count(*) as double) as cancelled_percent from flights group by all""",
    "destination_delays": """
select dest, count(*) as arrivals, count(*) filter (arr_delay > 15) as late_arrivals,
 cast(count(*) filter (arr_delay > 15) as double) * cast(100 as double) / cast(count(*) as double) as late_percent,
 cast(sum(arr_delay) filter (arr_delay > 15) // nullif(count(*) filter (arr_delay > 15), 0) as double) as avg_delay_trunc,
 cast(sum(arr_delay) filter (arr_delay > 15) as double) / cast(nullif(count(*) filter (arr_delay > 15), 0) as double) as avg_delay
from flights where arr_delay is not null group by dest""",
    "route_delays": f"""
select origin, dest, count(*) as flights, count(*) filter ({_DELAYED}) as delayed_flights,
 cast(count(*) filter ({_DELAYED}) as double) * cast(100 as double) / cast(count(*) as double) as delay_percent
from flights where dep_delay is not null group by origin, dest having count(*) >= {PARAMS['route_delays']['min_flights']}""",
    "airport_traffic": f""", o as (select origin as airport, count(*) as d, count(*) filter ({_DELAYED}) as dd, count(*) filter (cancelled = 1) as c from flights group by origin),
t as (select dest as airport, count(*) as a, count(*) filter (arr_delay > 15) as ad from flights group by dest)
select airport, coalesce(d, 0) as departures, coalesce(a, 0) as arrivals, coalesce(dd, 0) as delayed_departures, coalesce(ad, 0) as late_arrivals,
 coalesce(c, 0) as cancelled_departures from o full outer join t using (airport)""",
    "merger_impact": f""", e(absorbed, into_, y, m, d) as (values {', '.join(map(str, PARAMS['merger_impact']['mergers']))}),
x as (select concat(absorbed, ' into ', into_) as event, make_date(y, m, d) as day, unnest([absorbed, into_]) as carrier from e),
f as (select carrier, {_DAY} as at_day, dep_delay, cancelled from flights)
select event, case when at_day < day then 'before' else 'after' end as phase, count(*) as flights, count(*) filter ({_DELAYED}) as delayed_flights,
 count(*) filter (cancelled = 1) as cancelled_flights,
 cast(count(*) filter ({_DELAYED}) as double) * cast(100 as double) / cast(count(*) as double) as delay_percent
from f join x using (carrier) where at_day between day - {PARAMS['merger_impact']['days']} and day + {PARAMS['merger_impact']['days'] - 1} group by 1, 2""",
    "delay_percent_by_year": f"""
select year, count(*) as flights, count(*) filter ({_DELAYED}) as delayed_flights,
 cast(count(*) filter ({_DELAYED}) as double) * cast(100 as double) / cast(count(*) as double) as delay_percent
from flights where dep_delay is not null group by year""",
}


#: The streams' results, as the batch that they amount to: days that end seven days or more before the last one seen.
STREAM_SQL = {
    "streamed_daily_delays": _LEGS + f"""
select cast(day as string) as day, cast(isodow(day) as integer) as day_of_week, count(*) as flights, count(*) filter ({_DELAYED}) as delayed_flights,
 count(*) filter (cancelled = 1) as cancelled_flights, cast(sum(case when {_DELAYED} then dep_delay else 0 end) as bigint) as delay_minutes
from legs where day + 1 <= (select max(day) from legs) - 7 group by day""",
}
