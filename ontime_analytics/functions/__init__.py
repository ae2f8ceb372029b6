"""Column functions: parsing (P*), labels and the DST calendar."""

from ontime_analytics.functions.calendar import filter_dst_days, is_dst_crossover
from ontime_analytics.functions.parse import (
    cancellation_reason,
    delayed_rows,
    distance_band,
    distance_band_index,
    distance_band_label,
    exact_mean,
    has_delay,
    int_div,
    is_cancelled,
    month_name,
    net_delay_positive,
    percent,
    strict_int,
    tail_key,
    truncated_mean,
    weekday_name,
)

__all__ = [
    "cancellation_reason", "delayed_rows", "distance_band", "distance_band_index", "distance_band_label", "exact_mean", "filter_dst_days", "has_delay",
    "int_div", "is_cancelled", "is_dst_crossover", "month_name", "net_delay_positive",
    "percent", "strict_int", "tail_key", "truncated_mean", "weekday_name",
]
