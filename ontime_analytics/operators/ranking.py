"""F6 thresholds (HAVING) and O1/O2 top/bottom-k over a grouped result.

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps its
k best rows and only those reach the final merge - no global sort.  The group
key is always the tie-break (ascending), so the k rows are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def at_least(df: DataFrame, column: str, threshold) -> DataFrame:
    return df.filter(F.col(column) >= threshold)


def at_most(df: DataFrame, column: str, threshold) -> DataFrame:
    return df.filter(F.col(column) <= threshold)


def top_k(df: DataFrame, column: str, k: int, keys: Sequence[str]) -> DataFrame:
    """The k rows with the highest ``column``; ties broken by ``keys``."""
    order = [F.col(column).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in keys]
    return df.orderBy(*order).limit(k)


def bottom_k(df: DataFrame, column: str, k: int, keys: Sequence[str]) -> DataFrame:
    """The k rows with the lowest ``column``; ties broken by ``keys``."""
    order = [F.col(column).asc_nulls_last()] + [F.col(c).asc_nulls_first() for c in keys]
    return df.orderBy(*order).limit(k)
