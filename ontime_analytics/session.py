"""SparkSession defaults for the engine, and the shared checkpoint folder.

The defaults aim at large inputs: AQE re-plans at runtime (coalesces small
shuffle partitions, splits skewed ones, converts joins once real sizes are
known), Parquet scans read 256 MB splits, and the UI stays off.  The launcher's
settings (``--conf``, ``spark-defaults.conf``) and those of a running session
win: :func:`get_session` only fills in what is unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def _already_set(explicit: dict[str, str]) -> set[str]:
    """Settings of a running session, or of the launcher (``--conf``, ``spark-defaults.conf``).

    Reading the launcher's needs its JVM; when none runs yet, it is started with
    the ``explicit`` settings, as the session builder would."""
    running = SparkSession.getActiveSession()
    if running is not None:
        keys = {r.key for r in running.sql("SET").collect()}
        return keys | {k for k, _ in running.sparkContext.getConf().getAll()}
    from pyspark import SparkConf, SparkContext

    conf = SparkConf(loadDefaults=False)
    for k, v in explicit.items():
        conf.set(k, v)
    SparkContext._ensure_initialized(conf=conf)
    return {k for k, _ in SparkConf(loadDefaults=True).getAll()}


def get_session(app_name: str = "ontime_analytics", master: str | None = None,
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SCALE_DEFAULTS` for whatever neither the launcher,
    a running session nor the arguments set."""
    explicit = {k: str(v) for k, v in conf.items()}
    if shuffle_partitions is not None:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    try:
        taken = _already_set(explicit)
    except Exception:  # Spark Connect: no local JVM; the server's own settings apply
        taken = set(SCALE_DEFAULTS)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**{k: v for k, v in SCALE_DEFAULTS.items() if k not in taken}, **explicit}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("WARN")
    except Exception:  # Spark Connect has no SparkContext; the server logs
        pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set by the launcher to a shared file system.  Only
    a local-mode session without it (tests) gets a private temporary folder."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's own configuration applies
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        return path
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(path)
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="ontime-ckpt-")
    sc.setCheckpointDir(path)
    return path


def has_shared_folder(spark: SparkSession) -> bool:
    """Whether ``spark.checkpoint.dir`` is configured (not a private folder of this session)."""
    return bool(spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))


def streaming_checkpoint(spark: SparkSession, name: str) -> str:
    """Per-query streaming checkpoint location under the shared folder."""
    return os.path.join(checkpoint_dir(spark), "streams", name)


def write_scratch(df: DataFrame, name: str) -> str:
    """Write ``df`` as a new Parquet table under the shared folder; returns its path."""
    path = os.path.join(checkpoint_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete ``path`` through the Hadoop file system that holds it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
