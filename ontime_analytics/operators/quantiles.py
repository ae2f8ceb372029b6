"""Exact quantiles from histograms of whole-number values.

The partial state of a group is how often it has each value: counted map-side,
stored and merged across loads like any sum.  A quantile is found on the running
count of a group's distinct values; no values are collected, and a group with a
third of all flights has no more distinct delays than another.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shares are given in thousandths, so that the rank they fall on is computed in whole numbers.
SHARES = {"p50": 500, "p90": 900, "p95": 950, "p99": 990}


def histogram(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """``by, value, n``: how often each non-NULL value occurs in a group."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("long").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def merged(histograms: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """One histogram for several, such as those stored with each load."""
    return reduce(DataFrame.unionByName, histograms).groupBy(*by, "value").agg(F.sum("n").alias("n"))


def quantiles(hist: DataFrame, by: Sequence[str], shares: dict[str, int] = SHARES) -> DataFrame:
    """Per group ``rows``, for each name the least value that so many thousandths of the rows do not exceed, and the
    ``median`` between the two middle values."""
    for name, share in shares.items():
        if not 0 <= share <= 1000:
            raise ValueError(f"{name}: a share is in thousandths")
    upto = Window.partitionBy(*by).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = hist.withColumns({"_upto": F.sum("n").over(upto), "_all": F.sum("n").over(Window.partitionBy(*by))})

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto") >= rank, F.col("value")))

    div = lambda a, b: F.call_function("div", a, F.lit(b))
    low, high = at(div(F.col("_all") + 1, 2)), at(div(F.col("_all") + 2, 2))
    return placed.groupBy(*by).agg(
        F.sum("n").cast("long").alias("rows"),
        *[at(F.greatest(div(F.col("_all") * share + 999, 1000), F.lit(1))).alias(name) for name, share in shares.items()],
        ((low + high) / F.lit(2.0)).alias("median"))


def airport_delay_quantiles(flights: DataFrame) -> DataFrame:
    """Per origin the median and upper quantiles of the departure delay, over flights with a parsable one."""
    return quantiles(histogram(flights, ["origin"], "dep_delay"), ["origin"])


def carrier_year_delay_quantiles(flights: DataFrame) -> DataFrame:
    """The same per carrier and year; the histograms of the years are merged as those of separate loads would be."""
    by = ["carrier", "year"]
    return quantiles(histogram(flights, by, "dep_delay"), by)
