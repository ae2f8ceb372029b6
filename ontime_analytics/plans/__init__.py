"""Named queries (catalog) and their oracle SQL for DuckDB."""

from ontime_analytics.plans.catalog import FIXTURE_PARAMS, QUERIES, build, fixture_query

__all__ = ["FIXTURE_PARAMS", "QUERIES", "build", "fixture_query"]
