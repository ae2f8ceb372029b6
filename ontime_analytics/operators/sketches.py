"""Approximate distinct counts by mergeable sketches.

A HyperLogLog sketch of 2^12 registers takes a few kilobytes whatever it has
counted, and sketches of separate loads or months merge into that of all.
Where the exact count is wanted too, it needs every distinct key once more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REGISTERS_LOG2 = 12
#: Three standard errors of an estimate, as a share of the count (0.83 / sqrt(registers) each), and one for rounding.
BOUND = 3 * 0.83 / 2 ** (REGISTERS_LOG2 / 2)


def sketches(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """``by, sketch``: what a load stores to count the distinct non-NULL values."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.hll_sketch_agg(value, F.lit(REGISTERS_LOG2)).alias("sketch"))


def merged(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of finer groups, or of several loads, as one per ``by``."""
    return stored.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimates(stored: DataFrame, name: str = "estimate") -> DataFrame:
    return stored.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def carrier_year_tails(flights: DataFrame) -> DataFrame:
    """Distinct known tails per carrier and year, exact, and whether the estimate merged from monthly sketches is within three standard errors."""
    by = ["carrier", "year"]
    known = flights.filter(F.col("tail_num").isNotNull() & (F.col("tail_num") != "NA")).select(*by, "month", "tail_num").distinct()  # one scan for both counts
    estimate = estimates(merged(sketches(known, [*by, "month"], "tail_num"), by))
    months = known.groupBy(*by, "tail_num").agg(F.count(F.lit(1)).alias("months"))
    exact = months.groupBy(*by).agg(F.count_if(F.col("months") > 0).alias("tails"))
    e = estimate.select(F.col("carrier").alias("c"), F.col("year").alias("y"), "estimate")
    within = F.abs(F.col("estimate") - F.col("tails")) <= F.col("tails") * F.lit(BOUND) + 1
    return exact.join(e, exact["carrier"].eqNullSafe(e["c"]) & exact["year"].eqNullSafe(e["y"])).select(*by, "tails", within.alias("within_bound"))
