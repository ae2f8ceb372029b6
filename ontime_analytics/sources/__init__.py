"""Sources: flight CSV (S1), registry text (S2/S3), lake ingest (S4), fixtures."""

from ontime_analytics.sources.fixture import fixture_flights, fixture_registry
from ontime_analytics.sources.flights import (
    bad_rows,
    read_flights,
    read_flights_csv,
    read_flights_raw,
    type_flights,
)
from ontime_analytics.sources.ingest import ingest_flights
from ontime_analytics.sources.registry import (
    parse_model_lookup,
    parse_registry_master,
    read_model_lookup,
    read_registry_master,
)

__all__ = [
    "bad_rows", "fixture_flights", "fixture_registry", "ingest_flights", "parse_model_lookup",
    "parse_registry_master", "read_flights", "read_flights_csv", "read_flights_raw",
    "read_model_lookup", "read_registry_master", "type_flights",
]
