"""Distance and active-airline impact (Q29, Q30)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics.functions.parse import (
    distance_band_index,
    distance_band_label,
    has_delay,
    is_cancelled,
)


def distance_impact(flights: DataFrame) -> DataFrame:
    """Q29: all, cancelled and delayed flights per 500-mile distance band.

    Three conditional counts in one aggregate replace three keyed counts
    glued by union + groupByKey; a band with no cancellations shows 0.  Rows
    are grouped by the integer band index; only the 12 result rows get their
    text label (no string built per flight)."""
    agg = flights.groupBy(distance_band_index().alias("_band")).agg(
        F.count(F.lit(1)).alias("flights"),
        F.count_if(is_cancelled()).alias("cancelled_flights"),
        F.count_if(has_delay()).alias("delayed_flights"),
    )
    return agg.select(distance_band_label("_band").alias("distance_band"),
                      "flights", "cancelled_flights", "delayed_flights")


def monthly_airlines_delays(flights: DataFrame) -> DataFrame:
    """Q30: per (year, month): flights, distinct active carriers, delayed flights.

    Exact distinct count: Spark plans it as a two-level aggregate - partial
    aggregation on (year, month, carrier), then the distinct count - so only
    distinct triples are shuffled, however skewed a month or carrier is."""
    return flights.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("flights"),
        F.countDistinct("carrier").alias("airlines"),
        F.count_if(has_delay()).alias("delayed_flights"),
    )
