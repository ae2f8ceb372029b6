"""Exact deduplication by content-defined chunk recipes.

A text is cut where a hash of the last eight bytes says so; its recipe is the
ordered list of its chunks' identifiers.  An identifier is a chunk's 128-bit
digest once all chunks of that digest have been compared byte for byte: a run
of some 4 MB of text sends a chunk's bytes once, however many of its documents
hold it.  Documents are equal when their identifier lists are; only those short
lists are grouped and joined, never the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics.llm.common import drop, join_groups, slices, store, tidy, utf8

MIN_CHUNK, MAX_CHUNK, CUT_BITS = 256, 8192, 10
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def cut_places(data: bytes) -> np.ndarray:
    """Ends of the eight-byte windows whose hash asks for a cut, ascending (a function of each window alone)."""
    found = []
    for at in range(8):
        n = (len(data) - at) // 8
        if n > 0:
            words = np.frombuffer(data, "<u8", count=n, offset=at)
            found.append(np.flatnonzero((words * _MULTIPLIER) >> np.uint64(64 - CUT_BITS) == 0) * 8 + at + 8)
    return np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)


def chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The chunks of each text; joined, they give the text.  Empty texts have none."""
    data = b"".join(texts)
    places = cut_places(data)
    start = 0
    for t in texts:
        end = start + len(t)
        out, at = [], start
        for c in places[np.searchsorted(places, start + 8):np.searchsorted(places, end)].tolist():
            while c - at > MAX_CHUNK:
                out.append(data[at:at + MAX_CHUNK])
                at += MAX_CHUNK
            if c - at >= MIN_CHUNK:
                out.append(data[at:c])
                at = c
        while end - at > MAX_CHUNK:
            out.append(data[at:at + MAX_CHUNK])
            at += MAX_CHUNK
        if end > at:
            out.append(data[at:end])
        yield out
        start = end


def _recipes(digest_bytes: int):
    def run(batches):
        for b in slices(batches):
            texts = [t.lower() for t in utf8(b.column("text"))]
            lists = [b"".join(xxhash.xxh3_128_digest(c)[:digest_bytes] for c in cs) for cs in chunks(texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row"), b.column("text_hash"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts]), pa.array(lists, pa.binary())],
                ["doc_id", "row", "text_hash", "n_bytes", "text_sha256", "recipe"])
    return run


def _contents(digest_bytes: int):
    def run(batches):
        for b in slices(batches):
            seen: dict[tuple[bytes, bytes], None] = {}
            for cs in chunks([t.lower() for t in utf8(b.column("text"))]):
                for c in cs:
                    seen[(xxhash.xxh3_128_digest(c)[:digest_bytes], c)] = None
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen], pa.binary()),
                                              pa.array([c for _, c in seen], pa.binary())], ["digest", "data"])
    return run


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest_bytes: int = 16) -> DataFrame:
    """One row per row of ``docs``: ``row, doc_id, keep_id, group_size, kept, text_sha256, text_hash``.

    Texts are equal when they are after lower-casing A-Z; null is the empty
    text.  Of equal texts, the row with the largest id stays (a null id is
    below all others; of rows that repeat the largest id, one stays).  ``row``
    numbers the rows of this run, ``text_hash`` is Spark's xxhash64 of the text as
    given.  ``digest_bytes`` shortens the digests (the
    tests use it to force collisions): documents holding a chunk whose digest
    stands for several byte strings are told apart by the SHA-256 of their text
    besides.  Other columns are ignored; an empty table gives no rows.
    """
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    rows = base.withColumn("row", F.monotonically_increasing_id()).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    recipes, _ = store(rows.mapInArrow(
        tidy(_recipes(digest_bytes)), "doc_id long, row long, text_hash long, n_bytes long, text_sha256 string, recipe binary"), "recipes")

    contents = base.select("text").mapInArrow(tidy(_contents(digest_bytes)), "digest binary, data binary")
    unverified, path = store(contents.groupBy("digest").agg(F.min("data").alias("low"), F.max("data").alias("high"))
                          .filter("low != high").select("digest"), "unverified")
    rows = recipes.withColumn("apart", F.lit(None).cast("string"))
    if not unverified.isEmpty():
        parts = recipes.filter("length(recipe) > 0").select("row", F.explode(F.expr(
            f"transform(sequence(1, length(recipe), {digest_bytes}), i -> substring(recipe, i, {digest_bytes}))")).alias("digest"))
        doubtful = parts.join(unverified, "digest", "left_semi").select("row").distinct().withColumn("doubtful", F.lit(True))
        rows = recipes.join(doubtful, "row", "left").withColumn("apart", F.when(F.col("doubtful"), F.col("text_sha256"))).drop("doubtful")
    else:
        drop(docs.sparkSession, path)
    key = ["recipe", F.coalesce("apart", F.lit("")).alias("apart")]
    groups, _ = store(rows.groupBy(*key).agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size"))
                      .filter("group_size > 1"), "groups")
    met = join_groups(rows.withColumn("apart", F.coalesce("apart", F.lit(""))), groups, ["recipe", "apart"], "group_size", recipes.count(), F.xxhash64("row"))
    return met.select(
        "row", "doc_id", F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("best").isNull() | (F.col("best.row") == F.col("row"))).alias("kept"), "text_sha256", "text_hash")
