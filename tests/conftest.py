from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from table_dirs import SF01  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from ontime_analytics.session import checkpoint_dir, get_session

    s = get_session("ontime_tests", master="local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # tests only: a private folder when none is configured
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck01():
    from oracle_check import duck

    return duck(SF01)


@pytest.fixture(scope="session")
def flights01(spark):
    from ontime_analytics.sources.fixture import fixture_flights

    return fixture_flights(spark, SF01)


@pytest.fixture(scope="session")
def aircraft01(spark):
    from ontime_analytics.operators.aircraft import aircraft_dimension
    from ontime_analytics.sources.fixture import fixture_registry

    return aircraft_dimension(*fixture_registry(spark, SF01))
