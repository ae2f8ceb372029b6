"""US daylight-saving crossover days, computed from the calendar rule.

Rule (US law): up to 2006 the clocks change on the first Sunday of April and
the last Sunday of October; from 2007 on the second Sunday of March and the
first Sunday of November.  Over 1987-2008 this yields the 44 crossover dates
the analysis is defined on.

The crossover days are found by the rule itself (:func:`is_dst_crossover`), a
column expression: no join, and no last year.  Before it, the windows that the
rule implies - 1-7 April and 25-31 October up to 2006, 8-14 March and 1-7
November from 2007 - stand as plain comparisons of month, day and year, so
they reach the Parquet scan (``year`` partition pruning, and row groups of a
lake sorted by month and day can be skipped).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_analytics import schema as S

# --- fixed values: the rule change year and the anchor days ---
RULE_CHANGE_YEAR = 2007  # Energy Policy Act of 2005, effective 2007


def flight_day(year: Column | str = "year", month: Column | str = "month", day_of_month: Column | str = "day_of_month") -> Column:
    """The flight's DATE; NULL where the three numbers are no date.

    Each of the three is named once, so what computes it is not repeated."""
    y, m, d = (F.col(c) if isinstance(c, str) else c for c in (year, month, day_of_month))
    return F.concat(y.cast("string"), F.lit("-"), m.cast("string"), F.lit("-"), d.cast("string")).try_cast("date")


def _first_sunday_after(year: Column, month: int, day: int) -> Column:
    """Day of month of the first Sunday strictly after ``year-month-day``."""
    return F.dayofmonth(F.next_day(F.make_date(year, F.lit(month), F.lit(day)), "Sun"))


def dst_start(year: Column) -> tuple[Column, Column]:
    """(month, day) on which daylight-saving time starts in ``year``."""
    new = year >= RULE_CHANGE_YEAR
    month = F.when(new, F.lit(3)).otherwise(F.lit(4))
    # second Sunday of March = first Sunday after March 7;
    # first Sunday of April = first Sunday after March 31
    day = F.when(new, _first_sunday_after(year, 3, 7)).otherwise(_first_sunday_after(year, 3, 31))
    return month, day


def dst_end(year: Column) -> tuple[Column, Column]:
    """(month, day) on which daylight-saving time ends in ``year``."""
    new = year >= RULE_CHANGE_YEAR
    month = F.when(new, F.lit(11)).otherwise(F.lit(10))
    # first Sunday of November = first Sunday after October 31;
    # last Sunday of October = first Sunday after October 24
    day = F.when(new, _first_sunday_after(year, 10, 31)).otherwise(_first_sunday_after(year, 10, 24))
    return month, day


def dst_year_range(year: Column | str = "year", first_year: int | None = S.DST_FIRST_YEAR,
                   last_year: int | None = None) -> Column:
    """``year`` lies in the range; an end that is ``None`` is open (dates exist for years 1 to 9999)."""
    y = F.col(year) if isinstance(year, str) else year
    return y.between(max(1, first_year or 1), min(9999, last_year or 9999))


def is_dst_crossover(year: Column | str = "year", month: Column | str = "month",
                     day_of_month: Column | str = "day_of_month",
                     first_year: int | None = S.DST_FIRST_YEAR,
                     last_year: int | None = None) -> Column:
    """True iff (year, month, day) is a crossover day within the year range.

    The date arithmetic sits inside ``when(in range)`` so that no out-of-range
    year ever reaches ``make_date`` (which raises under ANSI mode)."""
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    d = F.col(day_of_month) if isinstance(day_of_month, str) else day_of_month
    sm, sd = dst_start(y)
    em, ed = dst_end(y)
    hit = ((m == sm) & (d == sd)) | ((m == em) & (d == ed))
    return F.coalesce(F.when(dst_year_range(y, first_year, last_year), hit), F.lit(False))


def dst_windows(year: Column, month: Column, day: Column) -> Column:
    """The days on which a crossover can fall: one week for each change and rule."""
    old = ((month == 4) & (day <= 7)) | ((month == 10) & (day >= 25))
    new = ((month == 3) & (day >= 8) & (day <= 14)) | ((month == 11) & (day <= 7))
    return (old & (year < RULE_CHANGE_YEAR)) | (new & (year >= RULE_CHANGE_YEAR))


def filter_dst_days(flights: DataFrame, first_year: int | None = S.DST_FIRST_YEAR,
                    last_year: int | None = None) -> DataFrame:
    """Keep the flights on crossover days.

    Where this very plan parses the year from text, a filter on the three
    numbers would be moved below the parsing and parse them at every mention.
    There the columns go through a generator of one row, which filters do not
    pass; callers select the columns they need before."""
    if S.PARSED_HERE in flights.schema["year"].metadata:
        flights = flights.select(F.inline(F.array(F.struct(*flights.columns))))
    y, m, d = F.col("year"), F.col("month"), F.col("day_of_month")
    return (flights.filter(dst_year_range(y, first_year, last_year)).filter(dst_windows(y, m, d))
            .filter(is_dst_crossover(y, m, d, first_year, last_year)))
