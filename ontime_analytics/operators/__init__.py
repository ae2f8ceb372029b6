"""The analyses: each is ``f(flights[, aircraft], **params) -> DataFrame``."""

from ontime_analytics.operators import (  # noqa: F401
    aircraft,
    airports,
    asof,
    cancellations,
    coverage,
    cubes,
    delays,
    dst,
    impact,
    intervals,
    models,
    quantiles,
    ranking,
    ranks,
    reasons,
    routes,
    sketches,
    streaks,
)
from ontime_analytics.operators.aircraft import aggregate_by_model, aircraft_dimension

__all__ = ["aggregate_by_model", "aircraft_dimension", "aircraft", "airports", "asof", "cancellations", "coverage", "cubes",
           "delays", "dst", "impact", "intervals", "models", "quantiles", "ranking", "ranks", "reasons", "routes", "sketches", "streaks"]
