"""The corpus pipeline: toxicity, exact dedup, near dedup, benchmark decontamination, BPE encoding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before kept; all but the last return the columns of ``documents``.  Rows are
told apart by their id and a hash of their text, so ids may be null or repeat;
rows that agree in both are copies of one another.  Null texts count as empty;
an empty table goes through every stage and gives no rows; further columns pass
through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_analytics.llm.catalog import encoded_digests, table
from ontime_analytics.llm.common import drop, store, whole
from ontime_analytics.llm.decontaminate import find_leaks
from ontime_analytics.llm.exact_dedup import exact_duplicates
from ontime_analytics.llm.minhash import near_duplicates
from ontime_analytics.llm.toxicity import score, train

#: A trained classifier and a tokenizer library take part, which SQL cannot express.
ORACLE_SQL = None


def _rows_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id and text hash are in ``chosen``, one for each pair.

    Copies are dropped first, on the map side too, and the rows that are left
    are already dealt out as the join needs them: they move once."""
    key = ["no_id", "id", "hash"]
    keyed = lambda df, doc_id: df.withColumns({"no_id": doc_id.isNull(), "id": F.coalesce(doc_id, F.lit(0).cast("long"))})
    own = keyed(docs.select(whole(docs).alias("doc"), F.col("doc_id").cast("long").alias("own"),
                            F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("hash")), F.col("own"))
    c = keyed(chosen.select(F.col("doc_id").alias("own"), F.col("text_hash").alias("hash")), F.col("own"))
    return own.dropDuplicates(key).join(c.select(key), key, "left_semi").select("doc.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on a bounded sample of the labelled ones, does not reject."""
    model = train(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(whole(docs).alias("doc"), "text")
    return score(rows, model, keep=["doc"]).filter("not rejected").select("doc.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    return _rows_of(docs, exact_duplicates(docs).filter("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id; documents without words all stay."""
    judged, _ = store(near_duplicates(docs), "judged")
    grouped = judged.filter("kept and group is not null").groupBy("group") \
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("x")).select("x.*")
    blank = docs.filter(F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]", "") == "")
    return _rows_of(docs, grouped).unionByName(blank)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = find_leaks(docs.select(whole(docs).alias("doc"), "text"), table(spark, sf_dir, "benchmark"), keep=["doc"])
    return found.filter(F.size("leaks") == 0).select("doc.*")


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids (little-endian unsigned 32-bit), with digests of them and of the text decoded from them."""
    return encoded_digests(docs, "ids")


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("MinHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("BPE encoding and decoding", bpe_encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read again.

    A stage's table is deleted when the next one's is there; the last one stays."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            drop(spark, before)
        before = path
    return docs
