"""Column-level parsing and derived values (all built-in expressions).

Every function takes and returns :class:`pyspark.sql.Column`, so it stays in
whole-stage codegen and composes with any DataFrame.  No Python UDF anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ontime_analytics import schema as S

# A whole-field signed decimal integer, like Java's Integer.parseInt: no
# blanks, no decimal point, no exponent.  Spark's own cast would accept ' 20'
# and an ANSI cast would raise on 'NA', so the guard comes first.
INT_PATTERN = r"^[+-]?[0-9]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_int(c: Column | str, default: int | None = None) -> Column:
    """Parse a string field to INT; anything else (NA, '', ' 20', '5.7',
    overflow) is NULL, or ``default`` when one is given."""
    c = _col(c)
    parsed = F.when(c.rlike(INT_PATTERN), c.try_cast("int"))
    return parsed if default is None else F.coalesce(parsed, F.lit(default))


def has_delay(dep_delay: Column | str = "dep_delay") -> Column:
    """Departure delay parsed and strictly above 15 minutes; never NULL."""
    return F.coalesce(_col(dep_delay) > S.DELAY_THRESHOLD_MINUTES, F.lit(False))


def delayed_rows(dep_delay: Column | str = "dep_delay") -> Column:
    """Filter form of :func:`has_delay`: ``dep_delay > 15``.  In a filter a NULL
    drops the row just as ``false`` does, and the plain comparison (unlike the
    ``coalesce``) is pushed down to the Parquet scan."""
    return _col(dep_delay) > S.DELAY_THRESHOLD_MINUTES


def is_cancelled(cancelled: Column | str = "cancelled") -> Column:
    """cancelled flag equals 1 (unparsable was typed as 0)."""
    return F.coalesce(_col(cancelled) == 1, F.lit(False))


def _lookup(key: Column, pairs) -> Column:
    """Literal map lookup; a missing key gives NULL."""
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])[key]


def weekday_name(day_of_week: Column | str = "day_of_week") -> Column:
    """1..7 -> Monday..Sunday, else NULL."""
    return _lookup(_col(day_of_week), enumerate(S.WEEKDAY_NAMES, start=1))


def month_name(month: Column | str = "month") -> Column:
    """P5: 1..12 -> January..December, else NULL."""
    return _lookup(_col(month), enumerate(S.MONTH_NAMES, start=1))


def cancellation_reason(cancel_code: Column | str = "cancel_code") -> Column:
    """Upper-cased code -> reason; unknown codes give NULL."""
    return _lookup(F.upper(_col(cancel_code)), S.CANCELLATION_REASONS)


def distance_band_index(distance: Column | str = "distance") -> Column:
    """P7, numeric: -1 for NULL/negative, 0 for 0-500, k for the k-th 500-mile
    band above it (upper bound inclusive), and the last index above 5000."""
    d = _col(distance)
    w = S.DISTANCE_BAND_WIDTH
    top = S.DISTANCE_BAND_MAX // w
    return (F.when(d.isNull() | (d < 0), F.lit(-1))
            .when(d <= w, F.lit(0))
            .when(d > S.DISTANCE_BAND_MAX, F.lit(top))
            .otherwise(int_div(d - 1, F.lit(w)).cast("int")))


def distance_band_label(index: Column | str) -> Column:
    """Label of a band index: 'NA', '0-500', '501-1000', ..., '> 5000'."""
    i = _col(index)
    w = S.DISTANCE_BAND_WIDTH
    top = S.DISTANCE_BAND_MAX // w
    return (F.when(i == -1, F.lit("NA"))
            .when(i == 0, F.lit(f"0-{w}"))
            .when(i == top, F.lit(f"> {S.DISTANCE_BAND_MAX}"))
            .otherwise(F.concat((i * w + 1).cast("string"), F.lit("-"), ((i + 1) * w).cast("string"))))


def distance_band(distance: Column | str = "distance") -> Column:
    """500-mile band label, upper bound inclusive; NULL/negative -> 'NA'."""
    return distance_band_label(distance_band_index(distance))


def tail_key(tail_num: Column | str = "tail_num") -> Column:
    """Registry key of a (trimmed) tail number: one leading 'N' removed,
    unless the value is 'NA' or shorter than two characters."""
    t = _col(tail_num)
    strip = (t != "NA") & (F.length(t) >= 2) & t.startswith("N")
    return F.when(strip, t.substr(F.lit(2), F.length(t) - 1)).otherwise(t)


def int_div(a: Column, b: Column) -> Column:
    """Integral division truncating toward zero (SQL ``div``), like Java's ``/``."""
    return F.call_function("div", a, b)


def truncated_mean(total: Column | str, count: Column | str) -> Column:
    """Long sum divided by Long count with integer division, as DOUBLE."""
    return F.when(_col(count) > 0,
                  int_div(_col(total).cast("long"), _col(count)).cast("double"))


def exact_mean(total: Column | str, count: Column | str) -> Column:
    """Exact mean as DOUBLE (NULL for an empty group)."""
    return F.when(_col(count) > 0, _col(total).cast("double") / _col(count).cast("double"))


def percent(part: Column | str, whole: Column | str) -> Column:
    """Part * 100 / whole in DOUBLE (NULL for an empty group)."""
    return F.when(_col(whole) > 0,
                  _col(part).cast("double") * F.lit(100.0) / _col(whole).cast("double"))


def net_delay_positive(arr_delay: Column | str = "arr_delay",
                       dep_delay: Column | str = "dep_delay") -> Column:
    """Arrival + departure delay above zero (NULL if either is unparsable)."""
    return _col(arr_delay).cast("long") + _col(dep_delay).cast("long") > 0
