"""Toxicity severity by cumulative-link (proportional odds) regression on sparse word features.

P(grade <= k) = 1 / (1 + exp(-(threshold[k] - x.w))): one weight vector is
shared by all ordered thresholds.  Features are the distinct words of a text
and their first four, five and six bytes, hashed.  Training takes a bounded, documented number of labelled rows; scoring
reads every whole text against the few non-zero weights.
"""

from __future__ import annotations

import warnings
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ontime_analytics.llm.common import slices, tidy, utf8

FEATURE_BITS = 20
#: The columns that :func:`score` adds; ``keep`` columns of these names give way.
GIVEN = ("severity", "grade", "p_toxic", "rejected")
_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def word_features(word: bytes) -> list[int]:
    """Hashes of a word and, where they are shorter, of its first 4, 5 and 6 bytes."""
    mask = (1 << FEATURE_BITS) - 1
    return [zlib.crc32(word) & mask, *(zlib.crc32(b"^" + word[:k]) & mask for k in (4, 5, 6) if k < len(word))]


def words(text: bytes) -> set[bytes]:
    """The distinct words: A-Z lower-cased, ASCII punctuation and space between them."""
    return set(text.lower().translate(_WORDS).split())


def features(text: bytes) -> set[int]:
    return {f for w in words(text) for f in word_features(w)}


@dataclass
class Model:
    """Non-zero weights by feature and the ascending thresholds between the grades."""

    weights: dict[int, float]
    thresholds: list[float]

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every score (rows) and threshold k (columns)."""
        return 1 / (1 + np.exp(np.clip(np.asarray(self.thresholds)[None, :] - score[:, None], -50, 50)))


def _joined(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """All rows' features in a line, and the row of each."""
    flat = np.concatenate([np.asarray(r, np.int32) for r in rows]) if rows else np.empty(0, np.int32)
    return flat, np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])


def fit(rows: list, grades: list[int], n_grades: int, l1: float = 0.0005, steps: int = 200, least: int = 5) -> Model:
    """L1-regularised maximum likelihood by accelerated proximal gradient, in two passes (adaptive penalty).

    ``rows`` holds each text's distinct features; those of fewer than ``least``
    texts are left out.  With no rows, or with one grade only, the model has no
    weights and its thresholds give the grades' smoothed shares."""
    y = np.asarray(grades, np.int64)
    n = len(y)
    share = [(np.sum(y <= k) + 0.5 * (k + 1) / n_grades) / (n + 0.5) for k in range(n_grades - 1)] if n else \
        [0.999 + 0.0005 * k for k in range(n_grades - 1)]
    theta = np.log(np.asarray(share) / (1 - np.asarray(share)))
    if n == 0 or len(set(grades)) < 2:
        return Model({}, np.maximum.accumulate(theta).tolist())
    inverse, at = _joined(rows)
    count = np.bincount(inverse)

    def reduce(keep, cols, inverse, at):
        """Only the kept columns, renumbered."""
        renumber, on = (np.cumsum(keep) - 1).astype(np.int32), keep[inverse]
        return cols[keep], renumber[inverse[on]], at[on]

    cols, inverse, at = reduce(count >= least, np.arange(len(count)), inverse, at)
    sigma = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    def grad(w, theta):
        s = np.bincount(at, weights=w[inverse], minlength=n)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        up, low = sigma(edge[y + 1] - s), sigma(edge[y] - s)
        p = np.maximum(up - low, 1e-12)
        du, dl = up * (1 - up) / p, low * (1 - low) / p
        gt = np.zeros(n_grades + 1)
        np.add.at(gt, y + 1, -du)
        np.add.at(gt, y, dl)
        return np.bincount(inverse, weights=(du - dl)[at], minlength=len(cols)) / n, gt[1:-1] / n

    # a feature whose slope at zero is below the penalty starts, and with few others near it stays, without a weight
    cols, inverse, at = reduce(np.abs(grad(np.zeros(len(cols)), theta)[0]) >= l1, cols, inverse, at)
    w = np.zeros(len(cols))
    # the curvature in a weight is at most half the mean, over the texts with its word, of their number of features
    size = np.bincount(at, minlength=n) + n_grades - 1.0
    step_w = 2 * n / np.maximum(np.bincount(inverse, weights=size[at], minlength=len(cols)), 1)
    step_t = 2 / size.mean()
    prev_w, prev_t = w, theta
    for rate in (l1, None):
        if rate is None:  # once more with less penalty on what was found: it need not be shrunk to be sparse
            rate = l1 * np.minimum(1, 0.05 / np.maximum(np.abs(prev_w), 1e-9))
        v, t_ = prev_w, prev_t
        for k in range(steps):
            gw, gt = grad(v, t_)
            new_w = v - step_w * gw
            new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step_w * rate, 0)
            new_t = np.maximum.accumulate(t_ - step_t * gt + 1e-6 * np.arange(n_grades - 1))
            m = k / (k + 3)
            v, t_ = new_w + m * (new_w - prev_w), np.maximum.accumulate(new_t + m * (new_t - prev_t))
            prev_w, prev_t = new_w, new_t
    return Model({int(c): float(x) for c, x in zip(cols, prev_w) if x}, prev_t.tolist())


def severity_grades(rows: list, toxic: list[int], n_grades: int) -> list[int]:
    """Grades from 0/1 labels: 0 if not toxic; toxic texts by how many distinct features mark them.

    A feature marks toxicity if a toxic text is at least eight times as likely
    to have it and five of them do; the toxic texts are cut into grades 1 up by
    quantiles of that number, ties to the lower grade."""
    flat, at = _joined(rows)
    t = np.asarray(toxic, bool)
    size = int(flat.max()) + 1 if len(flat) else 1
    pos, neg = np.bincount(flat[t[at]], minlength=size), np.bincount(flat[~t[at]], minlength=size)
    n1, n0 = max(1, int(t.sum())), max(1, int((~t).sum()))
    marks = (pos >= 5) & ((pos + 0.5) / n1 >= 8 * (neg + 0.5) / n0)
    number = np.bincount(at[marks[flat]], minlength=len(toxic))
    cuts = np.quantile(number[t] if t.any() else [0], [k / (n_grades - 1) for k in range(1, n_grades - 1)])
    return [int(1 + np.sum(m > cuts)) if x else 0 for m, x in zip(number, toxic)]


def _feature_rows(batches):
    for b in slices(batches):
        rows = [np.array(sorted(features(t)), "<i4").tobytes() for t in utf8(b.column("text"))]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("toxic"), pa.array(rows, pa.binary())], ["id", "toxic", "features"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 8000, n_grades: int = 3, l1: float = 0.0005,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", label_id: str = "doc_id") -> Model:
    """Fit on at most ``max_rows`` labelled rows of ``docs``, those with the smallest hashes of their ids.

    Rows with a null id or label are left out, and labels of ids that ``docs``
    lacks, before the sample is taken; of repeated labels the larger counts.
    Rows that share an id are rows of the sample each, by the hash of their
    words, as far as ``max_rows`` goes.  With no labelled document (or an empty
    table) a warning is given: that model rejects nothing.  Only the sample's
    word hashes reach the driver."""
    present = docs.select(docs[id_col].cast("long").alias("id")).distinct()
    ids = labels.select(labels[label_id].cast("long").alias("id"), labels[label_col].cast("int").alias("toxic")).dropna() \
        .groupBy("id").agg(F.max("toxic").alias("toxic")).join(present, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(max_rows)
    base = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    sample = base.join(F.broadcast(ids), "id").select("id", "toxic", "text") \
        .mapInArrow(tidy(_feature_rows), "id long, toxic int, features binary").orderBy(F.xxhash64("id"), "id", F.xxhash64("features")).limit(max_rows).collect()
    if not sample:
        warnings.warn("toxicity: no document has a label, the model has no weights", stacklevel=2)
    rows, toxic = [np.frombuffer(r.features, "<i4") for r in sample], [int(r.toxic > 0) for r in sample]
    return fit(rows, severity_grades(rows, toxic, n_grades), n_grades, l1)


def score(docs: DataFrame, model: Model, reject_above: float = 0.25, id_col: str = "doc_id", text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, severity, grade, p_toxic, rejected`` (or ``keep`` columns and these).

    ``severity`` is the expected grade, ``grade`` the most likely one and
    ``p_toxic`` = P(grade > 0); a document is rejected when that is above
    ``reject_above``.  Null and empty texts have no features: the thresholds
    alone score them.  Ids may be null or repeat; other columns are ignored; an
    empty table gives no rows."""
    weights, thresholds = model.weights, model.thresholds
    cols = [c for c in keep if c not in GIVEN] if keep is not None else ["doc_id"]

    def run(batches):
        m = Model(weights, thresholds)
        cache: dict[bytes, list[int]] = {}  # a word's features that have a weight
        for b in slices(batches, text="__text"):
            eta = np.empty(b.num_rows)
            for i, t in enumerate(utf8(b.column("__text"))):
                hits = set()
                for w in words(t):
                    f = cache.get(w)
                    if f is None:
                        if len(cache) > 300_000:
                            cache.clear()
                        f = cache[w] = [x for x in word_features(w) if x in weights]
                    if f:
                        hits.update(f)
                eta[i] = sum(weights[f] for f in sorted(hits))
            p = m.above(eta)
            each = np.concatenate([1 - p[:, :1], p[:, :-1] - p[:, 1:], p[:, -1:]], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in cols), pa.array(p.sum(1)), pa.array(each.argmax(1), pa.int32()), pa.array(p[:, 0]),
                 pa.array(p[:, 0] > reject_above)], [*cols, "severity", "grade", "p_toxic", "rejected"])

    base = docs.select(*[docs[c] for c in cols], docs[text_col].cast("string").alias("__text")) if keep is not None else \
        docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("__text"))
    schema = StructType(base.schema.fields[:-1])
    for name, kind in (("severity", "double"), ("grade", "integer"), ("p_toxic", "double"), ("rejected", "boolean")):
        schema.add(name, kind)
    return base.mapInArrow(tidy(run), schema)
