"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

from ontime_analytics.session import SCALE_DEFAULTS, checkpoint_dir, streaming_checkpoint


def test_scale_defaults_are_set(spark):
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
                "spark.sql.adaptive.coalescePartitions.enabled"):
        assert spark.conf.get(key) == SCALE_DEFAULTS[key]
    assert spark.conf.get("spark.ui.enabled") == "false"


def test_checkpoint_dir_is_the_configured_one(spark):
    path = checkpoint_dir(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        assert path == configured
    assert spark.sparkContext.getCheckpointDir() is not None
    assert streaming_checkpoint(spark, "x").startswith(path)
    # DataFrame checkpoints land there
    assert spark.range(3).checkpoint(eager=True).count() == 3


LAUNCH = """
import os, sys
sys.path.insert(0, {root!r})
from ontime_analytics.session import get_session
{before}
s = get_session("t", master="local[1]", shuffle_partitions=3, **{{"spark.driver.memory": "600m"}})
print("GOT", *(s.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions",
                                       "spark.sql.parquet.filterPushdown")),
      s.sparkContext._jvm.Runtime.getRuntime().maxMemory() < 700 << 20)
"""


@pytest.mark.parametrize("before", ["", "from pyspark.sql import SparkSession\nSparkSession.builder.master('local[1]').config("
                                        "'spark.driver.memory', '600m').config('spark.sql.adaptive.enabled', 'false').config("
                                        "'spark.sql.files.maxPartitionBytes', '1000000').getOrCreate()"])
def test_settings_of_launcher_and_running_session_win(before):
    """In a process of its own: what --conf or a running session sets stays, the rest is filled in."""
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "pyspark-shell" if before else
           "--conf spark.sql.files.maxPartitionBytes=1000000 --conf spark.sql.adaptive.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", LAUNCH.format(root=str(Path(__file__).resolve().parent.parent), before=before)],
                         env=env, capture_output=True, text=True, timeout=180)
    assert "GOT 1000000 false 3 true True" in out.stdout, out.stdout + out.stderr[-2000:]
