"""Token counts by a two-tier lookup on the map side.

Tier one is a compact table (unit -> number of tokens) of the most frequent
units of the whole corpus, broadcast; its entries and their length are bounded
by parameters.  Tier two is a bounded cache in each worker, filled by encoding
what the table lacks, and kept from task to task.  To build the table each task of the first pass sends
at most ``per_task`` of its units with their counts through a shuffle, and the
chosen ones reach the driver; the counting pass has no shuffle.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics.llm.bpe import load
from ontime_analytics.llm.common import slices, tidy


def frequent_units(docs: DataFrame, path: str, table_size: int = 50_000, per_task: int = 5_000,
                   max_chars: int = 32, text_col: str = "text") -> dict[str, int]:
    """Token counts of the units most often seen, at most ``table_size`` of at most ``max_chars`` characters.

    Every row is read; each task keeps a counter of bounded size and sends its
    ``per_task`` most frequent units.  The choice only decides what is looked
    up fast: counts do not depend on it."""
    def run(batches):
        bpe, seen = load(path), Counter()
        for b in slices(batches):
            for t in b.column("text").to_pylist():
                seen.update(bpe.units(t or ""))
            if len(seen) > 400_000:
                seen = Counter(dict(seen.most_common(100_000)))
        top = [(u, c) for u, c in seen.most_common(per_task) if len(u) <= max_chars]
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in top], pa.string()), pa.array([c for _, c in top], pa.int64())], ["unit", "n"])

    top = docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(tidy(run), "unit string, n long") \
        .groupBy("unit").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "unit").limit(table_size)
    bpe = load(path)
    return {r.unit: len(bpe.ids(r.unit)) for r in top.select("unit").collect()}


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text",
                 table_size: int = 50_000, cache_size: int = 300_000) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit`` (``n_tokens > limit``).

    Counts are those of the tokenizers library for the whole text, without
    added tokens, truncation or padding; special strings inside a text count as
    that library takes them.  Null text counts as empty (0 tokens).  Null and
    repeated ids keep their rows; other columns are ignored; an empty table
    gives no rows.  ``path`` must be
    readable on every executor.
    """
    spark = docs.sparkSession
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    table = spark.sparkContext.broadcast(frequent_units(docs, path, table_size, text_col=text_col))
    name = uuid.uuid4().hex

    class Lengths(dict):
        def __init__(self, bpe):
            super().__init__(table.value)
            self.bpe = bpe

        def __missing__(self, unit):
            n = len(self.bpe.ids(unit))
            if len(unit) <= 64:
                if len(self) >= table_size + cache_size:
                    self.clear()
                    self.update(table.value)
                self[unit] = n
            return n

    def run(batches):
        # a function's own globals live for one task; this module lives as long as the worker and holds one table
        kept = sys.modules.setdefault("_ontime_llm_lengths", types.ModuleType("_ontime_llm_lengths")).__dict__
        if kept.get("name") != name:
            kept.update(name=name, lengths=Lengths(load(path)))
        bpe, lengths = load(path), kept["lengths"]
        for b in slices(batches):
            texts = [t or "" for t in b.column("text").to_pylist()]
            counts = [sum(map(lengths.__getitem__, bpe.units(t))) for t in texts]
            sizes = pa.compute.fill_null(pa.compute.binary_length(b.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), sizes, pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return base.mapInArrow(tidy(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
