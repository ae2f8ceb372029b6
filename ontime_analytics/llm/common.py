"""Helpers shared by the operators: text columns, shared-folder tables, streaming Arrow output."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_analytics.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def whole(df: DataFrame) -> Column:
    """A row of ``df`` as one struct, so that its columns cannot clash with those an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once to a new Parquet table in the shared checkpoint folder and reread it.

    This cuts the lineage: what was computed survives the loss of any executor.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table that :func:`store` wrote, through the file system that holds it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: A key with more than one in so many of all rows is hot; there are fewer such keys than this.  Longer keys are not broadcast.
HOT_SHARES, HOT_KEY_BYTES = 512, 1 << 16


def join_groups(rows: DataFrame, groups: DataFrame, key: list[str], size: str, total: int, salt: Column) -> DataFrame:
    """``rows`` left-joined with ``groups``, which has one row per ``key`` and how many rows that key has in ``size``.

    The fewer than ``HOT_SHARES`` groups with more than that share of the
    ``total`` rows are broadcast (at most 32 MB of keys); their rows, and rows
    with a null key, are then dealt out by ``salt``, and all others meet their
    group in a shuffle.  So no key, however hot, is one task's work."""
    rest = [c for c in groups.columns if c not in key]
    long_key = sum((F.octet_length(F.col(k).cast("string")) for k in key), F.lit(0)) > HOT_KEY_BYTES
    is_hot = (F.col(size) * HOT_SHARES > total) & ~long_key
    same = no_key = None
    for k in key:
        same = (F.col(k) == F.col(f"_hot_{k}")) if same is None else same & (F.col(k) == F.col(f"_hot_{k}"))
        no_key = F.col(k).isNull() if no_key is None else no_key | F.col(k).isNull()
    few = F.broadcast(groups.filter(is_hot).select(*[F.col(k).alias(f"_hot_{k}") for k in key], F.struct(*rest).alias("_hot")))
    met = rows.join(few, same, "left").drop(*[f"_hot_{k}" for k in key]) \
        .withColumn("_salt", F.when(F.col("_hot").isNull() & ~no_key, F.lit(0).cast("long")).otherwise(F.pmod(salt, F.lit(1 << 20)) + 1))
    other = groups.filter(~is_hot).select(
        *[F.col(k).alias(f"_cold_{k}") for k in key], F.lit(0).cast("long").alias("_cold_salt"), F.struct(*rest).alias("_cold"))
    same = F.col("_salt") == F.col("_cold_salt")
    for k in key:
        same = same & (F.col(k) == F.col(f"_cold_{k}"))
    return met.join(other, same, "left").select(*rows.columns, *[F.coalesce(F.col("_hot")[c], F.col("_cold")[c]).alias(c) for c in rest])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 4 << 20, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose ``text`` is about ``max_bytes`` in all.

    One row is never cut: a text above the bound forms a run of its own."""
    for b in batches:
        if not b.num_rows:
            continue
        i = b.schema.get_field_index(text)
        ends = pa.compute.cumulative_sum(pa.compute.fill_null(pa.compute.binary_length(b.column(i)), 0).cast("int64")).to_pylist()
        start, base = 0, 0
        for k, e in enumerate(ends):
            if e - base >= max_bytes:
                yield b.slice(start, k + 1 - start)
                start, base = k + 1, e
        if start < b.num_rows:
            yield b.slice(start)


def release() -> None:
    """Return freed memory to the system (workers serve one task after the other and would keep the most any took)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library than glibc
        pass


def tidy(run):
    """``run`` for ``mapInArrow`` with :func:`release` at its end."""
    def wrapped(batches):
        yield from run(batches)
        release()
    return wrapped


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays as bytes, plane by plane, compressed; sizes go first."""
    body = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    head = np.array([len(arrays), *(x for a in arrays for x in (len(a), a.itemsize))], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + body)


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    sizes = np.frombuffer(raw, "<u4", 2 * n, 4).reshape(n, 2).tolist()
    out, at = [], 4 + 8 * n
    for count, width in sizes:
        planes = np.frombuffer(raw, np.uint8, count * width, at).reshape(width, count)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1))
        at += count * width
    return out


#: What blocks and buckets send each other: kind and seq order a receiver's rows.
MESSAGE = "block binary, kind int, seq int, payload binary, doc_ids array<long>"


def message(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 5
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["block", "kind", "seq", "payload", "doc_ids"])


def messages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows (block, kind, seq, payload, doc_ids) one by one, each taken out of its batch only when it is due."""
    for b in batches:
        columns = [b.column(c) for c in ("block", "kind", "seq", "payload", "doc_ids")]
        for i in range(b.num_rows):
            yield tuple(c[i].as_py() for c in columns)
