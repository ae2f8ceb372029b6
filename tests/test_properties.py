"""Property tests: the Column functions against plain-Python statements of
the same rules, on batches of generated values (one Spark job per batch)."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ontime_analytics.functions import parse

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def java_parse_int(s):
    """Integer.parseInt restricted to ASCII digits: sign, digits, int range."""
    if s is None or s == "":
        return None
    body = s[1:] if s[0] in "+-" else s
    if not body or not all("0" <= ch <= "9" for ch in body):
        return None
    v = int(s)
    return v if INT_MIN <= v <= INT_MAX else None


def band(d):
    if d is None or d < 0:
        return "NA"
    if d <= 500:
        return "0-500"
    if d > 5000:
        return "> 5000"
    lo = ((d - 1) // 500) * 500 + 1
    return f"{lo}-{lo + 499}"


def tail(t):
    if t is not None and t != "NA" and len(t) >= 2 and t.startswith("N"):
        return t[1:]
    return t


def run(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


numberish = st.one_of(
    st.text(alphabet="0123456789+- .NAx", max_size=12),
    st.integers(min_value=-(2**40), max_value=2**40).map(str),
    st.sampled_from(["NA", "", " 20", "20 ", "+0", "-0", "2147483647", "2147483648", "-2147483648"]),
)


@SETTINGS
@given(st.lists(numberish, min_size=20, max_size=120))
def test_strict_int_is_java_parse_int(spark, values):
    assert run(spark, values, parse.strict_int) == [java_parse_int(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-1000, 12000)), min_size=20, max_size=200))
def test_distance_band_rule(spark, values):
    assert run(spark, values, parse.distance_band, "int") == [band(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="N0123A ", max_size=6)), min_size=20, max_size=120))
def test_tail_key_rule(spark, values):
    assert run(spark, values, parse.tail_key) == [tail(v) for v in values]


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(-50, 10**6)), min_size=5, max_size=60))
def test_means_and_percent(spark, pairs):
    df = spark.createDataFrame(pairs, "t long, n long")
    got = df.select(parse.truncated_mean("t", "n").alias("a"), parse.exact_mean("t", "n").alias("b"),
                    parse.percent("t", "n").alias("c")).collect()
    for (t, n), r in zip(pairs, got):
        if n > 0:
            q = abs(t) // n * (1 if t >= 0 else -1)  # Java long division truncates toward zero
            assert r.a == float(q) and r.b == t / n and r.c == t * 100.0 / n
        else:
            assert r.a is None and r.b is None and r.c is None
