"""Near-duplicate groups by fast similarity sketches, banding and exact verification.

A sketch of ``SIZE`` coordinates is filled by rounds: in each of the first
``SIZE`` rounds every element of a set falls into one hashed bin with a value
that grows with the round, in the next ``SIZE`` rounds all elements fall into
bin 0, 1, ...; a coordinate keeps its smallest value, and a set is done when
all are filled.  Every coordinate is thus filled, and two sketches agree in a
share of coordinates that concentrates around the sets' Jaccard similarity.

Documents with equal shingle sets form one class.  Classes that agree in one of
``BANDS`` bands meet in a bucket.  Round one verifies each member against the
bucket's pivot.  Round two takes the classes of buckets that still hold several
components and verifies every pair across components that exact prefix and
position filters leave.  Every verdict is on the full sets, and a group of
thousands of alike documents costs about one comparison each.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime_analytics.llm.common import drop, join_groups, slices, store, tidy, utf8
from ontime_analytics.llm.components import components

WORDS, SIZE, BANDS = 5, 128, 32  # a link of similarity 0.75 shares a band but for one in 190,000
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class WordHashes(dict):
    """64-bit hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes], hashes: WordHashes) -> list[np.ndarray]:
    """Each text's set as sorted distinct 64-bit hashes: its 5-word shingles, A-Z lower-cased; with one to four
    words their whole sequence; without words nothing.  Words end at space and \\t to \\r."""
    words = [t.lower().split() for t in texts]
    flat = np.fromiter(map(hashes.__getitem__, itertools.chain.from_iterable(words)), np.uint64, sum(map(len, words)))
    runs = np.zeros(max(0, len(flat) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        runs += flat[k:k + len(runs)] * _ODD[k]
    runs = _mix(runs)
    out, at = [], 0
    for w in words:
        n = len(w)
        if n >= WORDS:
            out.append(np.unique(runs[at:at + n - WORDS + 1]))
        elif n:
            whole = sum((flat[at + k:at + k + 1] * _ODD[k] for k in range(n)), np.full(1, n, np.uint64))
            out.append(_mix(whole))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``SIZE`` coordinates for each set (an empty set's stay at the maximum)."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((len(sets), SIZE), empty)
    flat = out.reshape(-1)
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    low = np.uint64((1 << 55) - 1)
    for r in range(2 * SIZE):
        if not len(elements):
            break
        x = _mix(elements + np.uint64((r + 1) * int(_ODD[0]) & (2 ** 64 - 1)))
        bins = (x >> np.uint64(57)).astype(np.int64) if r < SIZE else r - SIZE
        np.minimum.at(flat, of * SIZE + bins, (np.uint64(r) << np.uint64(55)) | (x & low))
        open_ = (out == empty).any(axis=1)[of]
        elements, of = elements[open_], of[open_]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A row of ``BANDS`` keys for each sketch; keys of different bands differ."""
    rows = SIZE // BANDS
    parts = sketch.reshape(len(sketch), BANDS, rows)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(sketch), BANDS)) * _ODD[4]
    for k in range(rows):
        key = _mix(key + parts[:, :, k] * _ODD[k])
    return key.astype(np.int64)


def _sketch_rows(batches):
    hashes = WordHashes()
    for b in slices(batches, 2 << 20):
        sets = shingle_sets(utf8(b.column("text")), hashes)
        keys = band_keys(sketches(sets))
        full = [len(s) > 0 for s in sets]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([xxhash.xxh3_128_digest(s.tobytes()) if f else None for s, f in zip(sets, full)], pa.binary()),
             pa.array([k if f else None for k, f in zip(keys, full)], pa.list_(pa.int64()))],
            ["doc_id", "text_hash", "n_shingles", "set_hash", "bands"])


def _verify(percent: int):
    def run(batches):
        hashes, group, pivot = WordHashes(), None, None
        for b in slices(batches, 2 << 20):
            sets = shingle_sets(utf8(b.column("text")), hashes)
            found = []
            for grp, salt, cls, s in zip(b.column("grp").to_pylist(), b.column("salt").to_pylist(), b.column("cls").to_pylist(), sets):
                if cls == grp:
                    group, pivot = (grp, salt), s
                    continue
                if group != (grp, salt):
                    raise RuntimeError(f"class {grp} has not reached its group")
                both = len(np.intersect1d(s, pivot, assume_unique=True))
                if 100 * both >= percent * (len(s) + len(pivot) - both):
                    found.append((cls, grp))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([g for _, g in found], pa.int64())], ["a", "b"])
    return run


def _links(pairs: DataFrame, texts: DataFrame, percent: int, table, most: int = 64) -> DataFrame:
    """The pairs (a, b) whose full sets are similar.  ``b``'s text is sent to its partners' groups of about ``most``."""
    sizes = pairs.groupBy("b").agg(F.count("*").alias("n"))
    sizes, _ = table(sizes, "sizes")
    dealt = pairs.join(sizes, "b").withColumn("salt", F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / most).cast("long")))
    dealt, _ = table(dealt.select(F.col("b").alias("grp"), "salt", F.col("a").alias("cls")), "pairs")
    dealt = dealt.unionByName(dealt.select("grp", "salt", F.col("grp").alias("cls")).distinct())
    sent = dealt.join(texts, "cls").select("grp", "salt", "cls", "text")
    return sent.repartition("grp", "salt").sortWithinPartitions("grp", "salt", F.col("cls") != F.col("grp")) \
        .mapInArrow(tidy(_verify(percent)), "a long, b long")


def _shingle_rows(batches):
    hashes = WordHashes()
    for b in slices(batches, 2 << 20):
        sets = shingle_sets(utf8(b.column("text")), hashes)
        yield pa.RecordBatch.from_arrays([b.column("cls"), b.column("component"), pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))],
                                         ["cls", "component", "shingles"])


def _across(texts: DataFrame, percent: int, table) -> DataFrame:
    """The pairs (a, b) of classes in different components that may be similar: exact prefix and position filters.

    With shingles ordered from rare to frequent, two sets that overlap enough
    share one of the first n - required + 1 of each, and from a shared one at
    the places i and j on they can share at most min(n - i, m - j) + 1.  So a
    shingle common to a large group only pairs classes that have little else.
    A shingle of one component pairs nothing; else the classes outside its
    largest component meet all, so a large component is never paired with itself."""
    rows, _ = table(texts.mapInArrow(tidy(_shingle_rows), "cls long, component long, shingles array<long>")
                    .select("cls", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")), "shingles")
    counts, _ = table(rows.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1"), "counts")
    placed = rows.join(counts, "shingle", "left").withColumn(
        "place", F.row_number().over(Window.partitionBy("cls").orderBy(F.coalesce("df", F.lit(1)), "shingle")))
    first, _ = table(placed.filter(F.col("df").isNotNull() & (F.col("place") <= F.expr(f"n - ceil({percent} * n / 100) + 1")))
                     .select("shingle", "cls", "component", "n", "place"), "prefixes")
    per_component = first.groupBy("shingle", "component").agg(F.count("*").alias("classes"))
    largest = per_component.groupBy("shingle").agg(F.max(F.struct("classes", "component")).alias("x"), F.count("*").alias("components"), F.sum("classes").alias("size")) \
        .filter("components > 1").select("shingle", F.col("x.component").alias("largest"), "size")
    dealt, _ = table(join_groups(first, largest, ["shingle"], "size", first.count(), F.xxhash64("cls")).filter("largest is not null"), "dealt")
    x, y = dealt.filter("component != largest").alias("x"), dealt.alias("y")
    need = F.expr(f"ceil({percent} * (x.n + y.n) / {100 + percent})")
    return x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & F.expr("x.component != y.component and (y.component = y.largest or x.cls < y.cls)")
                  & F.expr(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)")
                  & (F.expr("least(x.n - x.place, y.n - y.place) + 1") >= need)) \
        .select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept, group, text_hash``.

    Documents are linked when 100 * |both| >= ``percent`` * |either| on their
    full sets of distinct five-word shingles; ``component_id`` is the smallest
    id reachable over links, itself included, and ``kept`` says that it is the
    row's own.  A document without words or text has no shingles and no links.
    ``group`` numbers the groups of this run (null without shingles),
    ``text_hash`` is Spark's xxhash64 of the text.  Of equal ids each row is judged by its own text; a null id counts as larger
    than any other and is kept only where no id is known.  Other columns are
    ignored; an empty table gives no rows.
    """
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")) \
        .withColumn("text_hash", F.xxhash64("text"))
    made = []

    def table(df, name):
        out = store(df, name)
        made.append(out[1])
        return out

    rows, _ = store(base.select("doc_id", "text_hash", "text").mapInArrow(
        tidy(_sketch_rows), "doc_id long, text_hash long, n_shingles long, set_hash binary, bands array<long>"), "sketches")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n_shingles", "bands")).alias("x")
    classes, _ = table(rows.filter("set_hash is not null").groupBy("set_hash").agg(least, F.count("*").alias("copies")).select(
        "set_hash", "copies", F.col("x.doc_id").alias("text_id"), F.col("x.text_hash").alias("text_hash"), F.col("x.n_shingles").alias("n"),
        F.col("x.bands").alias("bands")).withColumn("cls", F.monotonically_increasing_id()), "classes")

    places = classes.select("cls", F.explode("bands").alias("key"))
    sizes, _ = table(places.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    n_places = BANDS * classes.count()
    members, _ = table(join_groups(places, sizes, ["key"], "size", n_places, F.xxhash64("cls")).filter("size is not null"), "members")
    # a bucket's pivot: the class that meets most others in its buckets, as the least altered of a group does
    met, _ = table(members.groupBy("cls").agg(F.sum("size").alias("met")), "met")
    pivots, _ = table(members.join(met, "cls").groupBy("key").agg(F.max(F.struct("met", "cls")).alias("x"), F.max("size").alias("of"))
                      .select("key", F.col("x.cls").alias("pivot"), "of"), "pivots")
    members, _ = table(join_groups(members, pivots, ["key"], "of", n_places, F.xxhash64("cls")).drop("of"), "members")
    wanted = members.select("cls").distinct().join(classes.select("cls", F.col("text_id").alias("doc_id"), "text_hash"), "cls")
    texts = base.join(wanted, (base["doc_id"].eqNullSafe(wanted["doc_id"])) & (base["text_hash"] == wanted["text_hash"]))
    texts, _ = table(texts.select("cls", "text").groupBy("cls").agg(F.first("text").alias("text")), "texts")
    pairs = members.filter("cls != pivot").select(F.col("cls").alias("a"), F.col("pivot").alias("b")).distinct()
    links, _ = table(_links(pairs, texts, percent, table), "links")
    parts, _ = table(components(links, made), "components")

    # round two: the classes of buckets that still hold several components
    placed = members.filter("size > 2").join(parts, F.col("cls") == F.col("node"), "left") \
        .select("key", "cls", F.coalesce("component", "cls").alias("component"))
    split = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high")
    split, _ = table(split.select("key"), "split")
    rest = placed.join(split, "key").select("cls", "component").distinct()
    found, _ = table(_links(_across(texts.join(rest, "cls"), percent, table), texts, percent, table), "links")
    if not found.isEmpty():
        parts, _ = table(components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(found), made), "components")

    of_class = classes.select("set_hash", "copies", "cls", "text_id").join(parts, F.col("cls") == F.col("node"), "left") \
        .select("set_hash", "copies", "text_id", F.coalesce("component", "cls").alias("component"))
    least = of_class.groupBy("component").agg(F.min("text_id").alias("component_id"))
    named, _ = store(of_class.join(least, "component").select("set_hash", "copies", "component_id", F.col("component").alias("group")), "named")
    for path in made:
        drop(docs.sparkSession, path)
    out = join_groups(rows.select("doc_id", "n_shingles", "set_hash", "text_hash"), named, ["set_hash"], "copies", rows.count(), F.xxhash64("doc_id", "text_hash"))
    mine = F.when(F.col("set_hash").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", mine.alias("component_id"), F.col("doc_id").eqNullSafe(mine).alias("kept"), "group", "text_hash")
