"""The aircraft registry, two fixed-width text files.

``MASTER.txt`` maps an N-number (without the leading ``N``) to a
manufacturer-model code; ``ACFTREF.txt`` maps that code to a model name.
Java-style 0-based half-open slices ``[a, b)`` become ``substring(value, a+1, b-a)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_analytics import schema as S


def _slice(col: str, bounds: tuple[int, int]):
    a, b = bounds
    return F.substring(F.col(col), a + 1, b - a)


def parse_registry_master(lines: DataFrame, value: str = "value") -> DataFrame:
    """Fixed-width MASTER lines -> (tail, mfr_model_code); tail trimmed."""
    return lines.select(
        F.trim(_slice(value, S.MASTER_TAIL_SLICE)).alias("tail"),
        _slice(value, S.MASTER_MODEL_CODE_SLICE).alias("mfr_model_code"),
    )


def parse_model_lookup(lines: DataFrame, value: str = "value") -> DataFrame:
    """Fixed-width ACFTREF lines -> (mfr_model_code, model); model trimmed."""
    return lines.select(
        _slice(value, S.ACFTREF_MODEL_CODE_SLICE).alias("mfr_model_code"),
        F.trim(_slice(value, S.ACFTREF_MODEL_NAME_SLICE)).alias("model"),
    )


def read_registry_master(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_registry_master(spark.read.text(path))


def read_model_lookup(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_model_lookup(spark.read.text(path))
