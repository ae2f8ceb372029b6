"""Benchmark decontamination: a BM25 index of the test items, queried by every passage with block-max WAND.

The roles are swapped against ordinary search: the small side (the items) is
indexed and broadcast, in blocks of bounded size, and the passages of the
corpus are the queries.  Scores are BM25 sums divided by the item's score
against itself, so one threshold serves items of every length and a passage
that holds a whole item scores 1.  Passages are windows of 2 S words at every
S words, S being at least the longest item: an item copied whole lies in one.

A passage first meets the blocks' bounds - the sum of its terms' block maxima,
with the terms common to many items counted by one constant per block - for
all passages at once; those that may reach the threshold go through block-max
WAND, which returns every item at or above it.  A hit then needs its question
and its answer part to be there, word by word.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from ontime_analytics.llm.common import drop, slices, store, tidy

K1, B = 1.2, 0.75
ITEM_BLOCK = 4           # items that share a block maximum
GROUP_ITEMS, GROUP_BYTES = 512, 1 << 20  # of the items indexed and broadcast at once
MAX_BYTES = 256 << 20    # of all items: what passes through the driver and is broadcast in all is bounded by it
LEAST_WINDOW = 64
PART = 1 << 20             # characters of text screened at once
SHINGLE = 3
_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str) -> list[bytes]:
    """Lower-cased words; ASCII punctuation and white space stand between them."""
    return text.lower().encode("utf-8", "replace").translate(_WORDS).split()


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words of an item's question and answer: split after the last question mark that something follows,
    else before the last sentence, else at two thirds of the words."""
    parts = re.split(r"(?<=\?)\s+(?=\S)", text.strip())
    if len(parts) < 2:
        parts = re.split(r"(?<=[.!?])\s+(?=\S)", text.strip())
    if len(parts) >= 2:
        q, a = words(" ".join(parts[:-1])), words(parts[-1])
        if q and a:
            return q, a
    all_ = words(text)
    cut = max(1, len(all_) * 2 // 3)
    return all_[:cut], all_[cut:]


def shingles(ws: list[bytes]) -> set[tuple]:
    return {tuple(ws[i:i + SHINGLE]) for i in range(len(ws) - SHINGLE + 1)} if len(ws) >= SHINGLE else {tuple(ws)} if ws else set()


@dataclass
class Index:
    """Postings of one group of items; items are numbered by length, so that a block's items are alike."""

    terms: dict[bytes, int]
    items: list[list[int]]
    scores: list[list[float]]
    best: list[float]
    block_best: np.ndarray   # term x block
    screen: np.ndarray       # the same without the common terms; a last row of zeros
    floor: np.ndarray        # what the common terms can add in a block
    ids: list
    parts: list[tuple[set, set]]
    window: int


def build_index(texts: list[tuple], df: dict[bytes, int], n_items: int, mean_words: float, common: float = 0.02) -> Index | None:
    """Index (id, text) items by the statistics of the whole benchmark; None if no item has a word."""
    docs = sorted(((i, t, Counter(words(t))) for i, t in texts), key=lambda x: (sum(x[2].values()), str(x[0]), x[1]))
    docs = [d for d in docs if d[2]]
    if not docs:
        return None
    idf = {w: math.log(1 + (n_items - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    terms: dict[bytes, int] = {}
    items, scores = [], []
    n_blocks = -(-len(docs) // ITEM_BLOCK)
    floor = np.zeros(n_blocks)
    for k, (_, _, tf) in enumerate(docs):
        size = sum(tf.values())
        raw = {w: idf[w] * c * (K1 + 1) / (c + K1 * (1 - B + B * size / mean_words)) for w, c in tf.items()}
        whole = sum(raw.values())
        shared = 0.0
        for w, x in raw.items():
            t = terms.setdefault(w, len(terms))
            if t == len(items):
                items.append([])
                scores.append([])
            items[t].append(k)
            scores[t].append(x / whole)
            if df[w] > common * n_items:
                shared += x / whole
        floor[k // ITEM_BLOCK] = max(floor[k // ITEM_BLOCK], shared)
    block_best = np.zeros((len(terms) + 1, n_blocks), np.float32)
    for t, (ks, ss) in enumerate(zip(items, scores)):
        np.maximum.at(block_best[t], np.asarray(ks) // ITEM_BLOCK, np.nextafter(np.asarray(ss, np.float32), np.float32(2)))
    screen = block_best.copy()
    for w, t in terms.items():
        if df[w] > common * n_items:
            screen[t] = 0
    longest = sum(docs[-1][2].values())
    return Index(terms, items, scores, [max(s) for s in scores], block_best, screen, floor, [d[0] for d in docs],
                 [tuple(map(shingles, question_answer(d[1]))) for d in docs], max(LEAST_WINDOW, longest))


def wand(index: Index, query: list[int], threshold: float) -> list[tuple[int, float]]:
    """(item, score) of every item scoring at least ``threshold`` for the distinct ``query`` terms (block-max WAND)."""
    items, scores, best = index.items, index.scores, index.best
    at = {t: 0 for t in query}
    live = sorted((items[t][0], t) for t in query)
    out = []

    def forward(t: int, to: int) -> None:
        at[t] = bisect_left(items[t], to, at[t])

    while live:
        bound, p = 0.0, -1
        for i, (_, t) in enumerate(live):
            bound += best[t]
            if bound >= threshold - 1e-9:
                p = i
                break
        if p < 0:
            break
        pivot = live[p][0]
        while p + 1 < len(live) and live[p + 1][0] == pivot:
            p += 1
        block = pivot // ITEM_BLOCK
        head = [t for _, t in live[:p + 1]]
        if float(index.block_best[head, block].sum()) < threshold - 1e-5:
            to = (block + 1) * ITEM_BLOCK
            if p + 1 < len(live):
                to = min(to, live[p + 1][0])
            for t in head:
                forward(t, to)
        elif live[0][0] == pivot:
            score = sum(scores[t][at[t]] for t in sorted(head))
            if score >= threshold - 1e-9:
                out.append((pivot, score))
            for t in head:
                at[t] += 1
        else:
            for t in head:
                forward(t, pivot)
        live = sorted((items[t][at[t]], t) for t in at if at[t] < len(items[t]))
    return out


def candidates(index: Index, docs: list[list[bytes]], threshold: float):
    """(document, window's first word) of the windows whose bound reaches the threshold in some block."""
    s, n_terms = index.window, len(index.terms)
    get = index.terms.get
    sizes = np.array([len(d) for d in docs], np.int64)
    ids = np.fromiter((get(w, n_terms) for d in docs for w in d), np.int64, int(sizes.sum()))
    # spans of s words; a window is two spans of a document in a row
    spans = np.maximum(1, -(-sizes // s))
    first = np.cumsum(spans) - spans
    doc_of = np.repeat(np.arange(len(docs)), sizes)
    place = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    useful = index.screen.any(axis=1)[ids]
    key = np.unique((first[doc_of[useful]] + place[useful] // s) * (n_terms + 1) + ids[useful])
    span, term = key // (n_terms + 1), key % (n_terms + 1)
    bound = np.zeros((int(spans.sum()) + 1, index.screen.shape[1]), np.float32)
    if len(key):
        starts = np.flatnonzero(np.concatenate([[True], span[1:] != span[:-1]]))
        bound[span[starts]] = np.add.reduceat(index.screen[term], starts, axis=0)
    both = bound[:-1].copy()
    inner = np.ones(len(both), bool)
    inner[first + spans - 1] = False  # a document's last span has none after it
    both[inner] += bound[1:][inner]
    hot = (both + index.floor.astype(np.float32) >= threshold - 1e-4).any(axis=1)
    owner = np.repeat(np.arange(len(docs)), spans)
    for k in np.flatnonzero(hot).tolist():
        d = int(owner[k])
        yield d, (k - int(first[d])) * s


def leaks(index: Index, texts: list[str], threshold: float, overlap: float) -> list[list[dict]]:
    """For each text its verified items, by item number; the best window of each counts."""
    docs = [words(t) for t in texts]
    out: list[dict] = [{} for _ in docs]
    for d, start in candidates(index, docs, threshold):
        part = docs[d][start:start + 2 * index.window]
        found = wand(index, sorted({t for t in map(index.terms.get, part) if t is not None}), threshold)
        if not found:
            continue
        mine = shingles(part)
        grams = {1: set(part), 2: set(zip(part, part[1:])), SHINGLE: mine}
        for item, score in found:
            shares = []
            for side in index.parts[item]:
                if not side:
                    shares.append(1.0)
                    continue
                n = len(next(iter(side)))
                have = mine if n == SHINGLE else {(w,) for w in grams[1]} if n == 1 else grams[2]
                shares.append(len(side & have) / len(side))
            if min(shares) >= overlap and (item not in out[d] or score > out[d][item]["score"]):
                out[d][item] = {"item_id": index.ids[item], "score": score, "question": shares[0], "answer": shares[1]}
    return [[hits[i] for i in sorted(hits)] for hits in out]


def _item_terms(batches):
    for b in batches:
        rows = [(r, w, n) for r, t in zip(b.column("row").to_pylist(), b.column("text").to_pylist()) for w, n in Counter(words(t or "")).items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                                          pa.array([r[2] for r in rows], pa.int64())], ["row", "term", "n"])


def find_leaks(docs: DataFrame, benchmark: DataFrame, keep: list[str], threshold: float = 0.6, overlap: float = 0.5,
               text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``keep`` columns of every row of ``docs`` and ``leaks``, an array of (item_id, score, question, answer).

    ``score`` is the share of the item's BM25 weight that one passage of the
    document reaches, at least ``threshold``; ``question`` and ``answer`` are
    the shares of their distinct three-word sequences in that passage, each at
    least ``overlap`` (a part of fewer words counts as one sequence).  Texts are
    read whole.  Null and empty texts and items have no leaks; repeated rows and
    items stay; other columns are ignored, and a ``keep`` column called
    ``leaks`` gives way; empty tables give no rows, or no leaks.  Items go in groups of at most about
    512 and 1 MB, each with an index that is broadcast; a worker queries a run of
    documents against one after the other, so a larger benchmark takes more time
    and no more memory.  Items of more than ``MAX_BYTES`` in all are refused:
    query such a benchmark part by part.
    """
    spark = docs.sparkSession
    items = benchmark.select(benchmark[item_col].cast("long").alias("item_id"), F.coalesce(benchmark[item_text].cast("string"), F.lit("")).alias("text")) \
        .withColumn("row", F.monotonically_increasing_id())
    terms = items.mapInArrow(tidy(_item_terms), "row long, term binary, n long")
    n_items, n_bytes = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if n_bytes > MAX_BYTES:
        raise ValueError(f"the items have {n_bytes} bytes, more than {MAX_BYTES}; query them part by part")
    n_words = terms.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-n_items // GROUP_ITEMS), -(-n_bytes // GROUP_BYTES))
    df, path = store(terms.groupBy("term").agg(F.count("*").alias("df")), "item-terms")
    shared = []
    for g in range(groups):
        mine = F.pmod(F.xxhash64("row"), F.lit(groups)) == g
        texts = [(r.item_id, r.text) for r in items.filter(mine).collect()]
        counts = {bytes(r.term): r.df for r in terms.filter(mine).select("term").distinct().join(df, "term").collect()}
        built = build_index(texts, counts, n_items, n_words / max(1, n_items))
        if built:
            shared.append(spark.sparkContext.broadcast(vars(built)))
    drop(spark, path)

    base = docs.select(*[docs[c] for c in keep if c != "leaks"], docs[text_col].cast("string").alias("__text"))
    hit = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())]))

    def run(batches):
        few = len(shared) <= 2
        held = [Index(**s.value) for s in shared] if few else []
        for b in slices(batches, PART if few else 16 * PART, text="__text"):
            texts = [t or "" for t in b.column("__text").to_pylist()]
            found: list[list[dict]] = [[] for _ in texts]
            for g, s in enumerate(shared):
                index = held[g] if few else Index(**s.value)
                at = 0
                while at < len(texts):
                    end, size = at, 0
                    while end < len(texts) and (end == at or size < PART):
                        size += len(texts[end])
                        end += 1
                    for i, hits in enumerate(leaks(index, texts[at:end], threshold, overlap), at):
                        found[i] += hits
                    at = end
                if not few:
                    vars(s).pop("_value", None)  # one index in memory at a time
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, hit)], [*b.schema.names[:-1], "leaks"])

    kind = ArrayType(StructType([StructField("item_id", LongType()), *(StructField(c, DoubleType()) for c in ("score", "question", "answer"))]))
    return base.mapInArrow(tidy(run), StructType([*base.schema.fields[:-1], StructField("leaks", kind)]))
