"""Hard negatives by angular triangle filtering.

A few reference directions are fitted on a bounded sample.  Every row keeps its
angles to them; it belongs to the cell of the nearest one, and a cell is cut
into chunks of bounded size by the hash of the id.  The angle between two
vectors lies between the largest difference and the smallest sum of their
angles to one reference, so stored angles give an interval for the cosine and,
times both norms, for the integer score.  Only rows whose interval meets a
window that an anchor still looks for are scored, in integers: a reference or
a rounding error can cost time but never change a result.

Anchors ask: for their positives (the best rows of their own label), then for
the negatives below each positive.  Each time the anchor's own chunk answers
first and narrows the window; then the question goes, by the cells' angles, to
the chunks that may still hold something.  Rows are shuffled to their chunks,
never copied; what is copied are anchors.  Tasks read a chunk and then stream
the questions to it, so memory is bounded by a chunk.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime_analytics.llm.common import drop, pack, partitions, store, tidy, unpack
from ontime_analytics.llm.whitening import usable

#: Reference directions, and the rows they are fitted on (at most twice as many are read).
REFERENCES = 16
SAMPLE = 2048
#: A chunk's vectors take about so many bytes; a piece of one has so many rows.
CHUNK_BYTES = 16 << 20
PIECE_ROWS = 2048

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
#: kind 0: a piece of a chunk; 1: a question; 2: an answer, of which many make up a result.
WIRE = ("cell int, chunk int, kind int, seq int, payload binary, anchor_id long, anchor_key long, label string, x binary,"
        " home_cell int, home_chunk int, wants array<struct<no:int,low:bigint,high:bigint>>, no int, score long, vec_id long")
_WANTS = pa.list_(pa.struct([("no", pa.int32()), ("low", pa.int64()), ("high", pa.int64())]))
_ARROW = {"cell": pa.int32(), "chunk": pa.int32(), "kind": pa.int32(), "seq": pa.int32(), "payload": pa.binary(), "anchor_id": pa.int64(),
          "anchor_key": pa.int64(), "label": pa.string(), "x": pa.binary(), "home_cell": pa.int32(), "home_chunk": pa.int32(), "wants": _WANTS,
          "no": pa.int32(), "score": pa.int64(), "vec_id": pa.int64()}
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def _wire(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in _ARROW.items()], list(_ARROW))


def fit_references(sample: np.ndarray, k: int = REFERENCES) -> np.ndarray:
    """At most ``k`` unit directions: farthest-first starts, moved to the middle of the rows nearest to them."""
    norms = np.linalg.norm(sample, axis=1)
    unit = sample[norms > 0] / norms[norms > 0][:, None]
    if not len(unit):
        return np.eye(1, max(sample.shape[1], 1))[:, :sample.shape[1]]
    chosen = [0]
    best = unit @ unit[0]
    while len(chosen) < min(k, len(unit)) and best.min() < 1 - 1e-9:
        chosen.append(int(best.argmin()))
        best = np.maximum(best, unit @ unit[chosen[-1]])
    centres = unit[chosen]
    for _ in range(8):
        nearest = (unit @ centres.T).argmax(axis=1)
        sums = np.stack([unit[nearest == j].sum(axis=0) if (nearest == j).any() else c for j, c in enumerate(centres)])
        length = np.linalg.norm(sums, axis=1)
        centres = np.where(length[:, None] > 1e-9, sums / np.maximum(length, 1e-9)[:, None], centres)
    return centres


def _angles(x: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms and angles to the references; a zero vector counts as at right angles to all."""
    f = x.astype(float)
    norms = np.sqrt((f * f).sum(axis=1))
    return norms, np.arccos(np.clip(f @ references.T / np.where(norms > 0, norms, 1)[:, None], -1, 1))


def slack(dim: int) -> float:
    """What the difference of two computed angles may be off: a cosine's error of d roundings, as an angle near 0."""
    return 4 * float(np.sqrt(2 * max(dim, 1) * 2.0 ** -52))


def bounds(norm: float, angles: np.ndarray, norms: np.ndarray, theirs: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score of one vector with rows that have ``norms`` and angles ``theirs``; safe against rounding."""
    apart = np.abs(theirs - angles).max(axis=1) - eps
    total = theirs + angles
    most = np.minimum(total.min(axis=1), 2 * np.pi - total.max(axis=1)) + eps
    size = norm * norms
    room = 1e-9 * size + 1e-6
    return size * np.cos(np.clip(most, 0, np.pi)) - room, size * np.cos(np.clip(apart, 0, np.pi)) + room


def _highest(norm: float, angles: np.ndarray, least: np.ndarray, most: np.ndarray, norm_low: np.ndarray, norm_high: np.ndarray, eps: float) -> np.ndarray:
    """The highest score that any row can have whose angles lie in the boxes ``least`` to ``most`` and norms between the given ones."""
    apart = np.maximum(least - angles, angles - most).max(axis=1) - eps
    cos = np.cos(np.clip(apart, 0, np.pi))
    size = norm * np.where(cos > 0, norm_high, norm_low)
    return size * cos + 1e-9 * norm * norm_high + 1e-6


class _Chunk:
    """The rows of one chunk, in pieces with the range of their angles and norms."""

    def __init__(self, dim: int, references: np.ndarray):
        self.dim, self.references, self.eps = dim, references, slack(dim)
        self.pieces: list[tuple] = []

    def add(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, norms: np.ndarray, angles: np.ndarray) -> None:
        self.pieces.append((ids, labels, x.astype(float), norms, angles))
        self.box = None

    def add_packed(self, payload: bytes) -> None:
        ids, codes, text, ends, x, norms, angles = unpack(payload)
        names, starts = text.tobytes(), [0, *ends.tolist()]
        known = np.array([names[a:b].decode() for a, b in zip(starts, starts[1:])], object)
        n = len(ids)
        self.add(ids.view(np.int64), known[codes], x.view(np.int32).reshape(n, self.dim), norms.view(float), angles.view(float).reshape(n, -1))

    def packed(self) -> list[bytes]:
        out = []
        for ids, labels, x, norms, angles in self.pieces:
            names, codes = np.unique(labels.astype(str), return_inverse=True)
            names = [s.encode() for s in names.tolist()]
            out.append(pack(ids.view(np.uint64), codes.astype(np.uint32), np.frombuffer(b"".join(names), np.uint8), np.cumsum([len(s) for s in names]).astype(np.uint32),
                            x.astype(np.int32).reshape(-1).view(np.uint32), norms.view(np.uint64), np.ascontiguousarray(angles).reshape(-1).view(np.uint64)))
        return out

    def answer(self, anchor_id: int, label: str, x: np.ndarray, wants: list[tuple[int, int, int]], same: bool, k: int, wide: bool) -> list[tuple[int, int, int]]:
        """(no, score, vec_id) of the first ``k`` rows, or what equals the last of them in score, within each want's
        scores; with ``same`` among the other ids of the label, else among the rows of other labels."""
        if self.box is None and self.pieces:
            self.box = tuple(np.stack(a) for a in zip(*[(p[4].min(axis=0), p[4].max(axis=0), p[3].min(), p[3].max()) for p in self.pieces]))
        norm, angles = (a[0] for a in _angles(x[None, :], self.references))
        low = np.array([w[1] for w in wants], np.int64)
        high = np.array([w[2] for w in wants], np.int64)
        found: list[list] = [[np.empty(0, np.int64), np.empty(0, np.int64)] for _ in wants]
        if not self.pieces or not len(wants):
            return []
        top = _highest(norm, angles, *self.box, self.eps)
        exact = x.astype(np.int64) if wide else x.astype(float)
        for i in np.argsort(-top, kind="stable").tolist():
            if top[i] < low.min():
                break
            ids, labels, rows, norms, theirs = self.pieces[i]
            at = np.flatnonzero((labels == label) & (ids != anchor_id) if same else labels != label)
            if not len(at):
                continue
            least, most = bounds(norm, angles, norms[at], theirs[at], self.eps)
            at = at[reduce(np.logical_or, [(most >= a) & (least <= b) for a, b in zip(low, high)])]
            if not len(at):
                continue
            scores = rows[at].astype(np.int64) @ exact if wide else (rows[at] @ exact).astype(np.int64)
            for w in range(len(wants)):
                good = (scores >= low[w]) & (scores <= high[w])
                if good.any():
                    s, d = np.concatenate([found[w][0], scores[good]]), np.concatenate([found[w][1], ids[at[good]]])
                    first = np.lexsort((d, -s))[:k]
                    found[w] = [s[first], d[first]]
                    if len(first) == k:
                        low[w] = max(low[w], int(s[first[-1]]))
        return [(w[0], s, d) for w, f in zip(wants, found) for s, d in zip(f[0].tolist(), f[1].tolist())]


def _prepare(rows: DataFrame, dim: int, references: np.ndarray, scale: float) -> DataFrame:
    """Integers, norm, angles and cell of every row."""
    def run(batches):
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 4096):
                b = whole_batch.slice(at, 4096)
                column = b.column("v")
                ends = column.offsets.to_numpy().astype(np.int64)
                full = np.zeros((b.num_rows, dim))
                full[np.arange(dim) < np.diff(ends)[:, None]] = column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
                full = np.floor(full * scale)
                if full.size and np.abs(full).max() >= 2 ** 31:
                    raise ValueError("an entry is too large for the integer scores")
                x = full.astype(np.int32)
                norms, angles = _angles(x, references)
                width = angles.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id"), b.column("label"), b.column("is_anchor"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(norms),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), pa.array(angles.reshape(-1))),
                     pa.array(angles.argmin(axis=1), pa.int32())],
                    ["vec_id", "label", "is_anchor", "x", "norm", "angles", "cell"])

    return rows.mapInArrow(tidy(run), "vec_id long, label string, is_anchor boolean, x binary, norm double, angles array<double>, cell int")


def _chunks(dim: int, references: np.ndarray, k: int, wide: bool):
    """The sorted rows of chunks become their pieces (kind 0), the anchors' questions (1) and what their own chunk has for them (2)."""
    def flush(key, parts):
        ids, labels, x, norms, angles, anchor, keys = (np.concatenate(a) for a in zip(*parts))
        if len(np.unique(ids)) < len(ids):  # rows alike in id, label and vector count once
            seen: dict = {}
            for i, row in enumerate(zip(ids.tolist(), labels.tolist(), map(bytes, x))):
                seen.setdefault(row, i)
            at = np.array(sorted(seen.values()))
            ids, labels, x, norms, angles, anchor, keys = (a[at] for a in (ids, labels, x, norms, angles, anchor, keys))
        chunk = _Chunk(dim, references)
        order = np.argsort(angles[:, key[0]], kind="stable")
        for at in range(0, len(order), PIECE_ROWS):
            i = order[at:at + PIECE_ROWS]
            chunk.add(ids[i], labels[i], x[i], norms[i], angles[i])
        where = {"cell": key[0], "chunk": key[1]}
        for seq, payload in enumerate(chunk.packed()):
            yield _wire([where | {"kind": 0, "seq": seq, "payload": payload}])
        for i in np.flatnonzero(anchor).tolist():
            who = {"anchor_id": int(ids[i]), "anchor_key": int(keys[i])}
            got = chunk.answer(int(ids[i]), labels[i], x[i], [(0, LOWEST, HIGHEST)], True, k, wide)
            yield _wire([where | who | {"kind": 1, "seq": 0, "label": labels[i], "x": x[i].tobytes(), "home_cell": key[0], "home_chunk": key[1]},
                         *[who | {"kind": 2, "no": no, "score": s, "vec_id": d} for no, s, d in got]])

    def run(batches):
        key, parts = None, []
        for b in batches:
            keys = list(zip(b.column("cell").to_pylist(), b.column("chunk").to_pylist()))
            at = 0
            while at < len(keys):
                end = at + 1
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if keys[at] != key:
                    if parts:
                        yield from flush(key, parts)
                    key, parts = keys[at], []
                part = b.slice(at, end - at)
                n = part.num_rows
                parts.append((part.column("vec_id").to_numpy(), np.array(part.column("label").to_pylist(), object),
                              np.frombuffer(b"".join(part.column("x").to_pylist()), np.int32).reshape(n, dim), part.column("norm").to_numpy(),
                              np.array(part.column("angles").to_pylist()).reshape(n, -1), part.column("is_anchor").to_numpy(zero_copy_only=False), part.column("key").to_numpy()))
                at = end
        if parts:
            yield from flush(key, parts)

    return run


def _answers(dim: int, references: np.ndarray, same: bool, k: int, wide: bool):
    """A chunk's pieces come first, then the questions to it."""
    def run(batches):
        key, chunk = None, None
        for b in batches:
            out = []
            cells, numbers, kinds = (b.column(c).to_pylist() for c in ("cell", "chunk", "kind"))
            for i in range(b.num_rows):
                if (cells[i], numbers[i]) != key:
                    key, chunk = (cells[i], numbers[i]), _Chunk(dim, references)
                if kinds[i] == 0:
                    chunk.add_packed(b.column("payload")[i].as_py())
                    continue
                who = {"kind": 2, "anchor_id": b.column("anchor_id")[i].as_py(), "anchor_key": b.column("anchor_key")[i].as_py()}
                wants = [(w["no"], w["low"], w["high"]) for w in b.column("wants")[i].as_py()]
                got = chunk.answer(who["anchor_id"], b.column("label")[i].as_py(), np.frombuffer(b.column("x")[i].as_py(), np.int32), wants, same, k, wide)
                out += [who | {"no": no, "score": s, "vec_id": d} for no, s, d in got]
                if len(out) >= 4096:
                    yield _wire(out)
                    out = []
            if out:
                yield _wire(out)

    return run


def _sent(dim: int, references: np.ndarray, cells: list[tuple]):
    """Questions go to all chunks but their own of the cells whose angles leave a score that a want still takes."""
    eps = slack(dim)
    least, most = np.array([c[2] for c in cells]), np.array([c[3] for c in cells])
    norm_low, norm_high = np.array([c[4] for c in cells]), np.array([c[5] for c in cells])

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                if not r["wants"]:
                    continue
                norm, angles = (a[0] for a in _angles(np.frombuffer(r["x"], np.int32)[None, :], references))
                top = _highest(norm, angles, least, most, norm_low, norm_high, eps)
                for i in np.flatnonzero(top >= min(w["low"] for w in r["wants"])).tolist():
                    for chunk in range(cells[i][1]):
                        if (cells[i][0], chunk) != (r["home_cell"], r["home_chunk"]):
                            out.append(r | {"cell": cells[i][0], "chunk": chunk})
                    if len(out) >= 1024:
                        yield _wire(out)
                        out = []
            if out:
                yield _wire(out)

    return run


def _first(answers: DataFrame, k: int) -> DataFrame:
    """Each question's first ``k`` answers, numbered; tasks keep ``k`` of each before they send any."""
    order = Window.partitionBy("anchor_id", "anchor_key", "no").orderBy(F.desc("score"), "vec_id")
    return answers.select("anchor_id", "anchor_key", "no", "score", "vec_id").withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k)


def _narrowed(questions: DataFrame, answers: DataFrame, k: int) -> DataFrame:
    """The questions with the score of the k-th answer so far as lowest, where there are so many."""
    last = answers.filter(F.col("at") == k).groupBy("anchor_id", "anchor_key").agg(F.map_from_entries(F.collect_list(F.struct("no", "score"))).alias("last"))
    lowest = lambda w: F.greatest(w["low"], F.coalesce(F.col("last")[w["no"]], w["low"]))
    return questions.join(last, ["anchor_id", "anchor_key"], "left").withColumn(
        "wants", F.transform("wants", lambda w: F.struct(w["no"].alias("no"), lowest(w).alias("low"), w["high"].alias("high"))))


def mine_hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256,
                        id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """For each anchor and positive the first ``negatives`` rows of another label whose score is from ``low`` to ``high`` percent of the positive's.

    ``anchors`` is a condition on the columns of ``vectors``.  Entries become
    ``floor(scale * c)``, scores are inner products; higher ones come first,
    ties by smaller id.  Positives are the first rows of the anchor's label
    with another id.  Rows with a null id, label or vector, or with null or
    non-finite entries, take no part.  Rows alike in id, label and vector count
    once; rows that only share an id count each.  Shorter vectors are filled up
    with zeros.  Entries that 32 bits cannot hold, and scores that 63 bits
    cannot, are refused.  An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    v = vectors[vector_col].cast("array<double>")
    rows = vectors.filter(usable(v) & vectors[id_col].isNotNull() & vectors[label_col].isNotNull()) \
        .select(vectors[id_col].cast("long").alias("vec_id"), vectors[label_col].cast("string").alias("label"), v.alias("v"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    if not size["n"]:
        return spark.createDataFrame([], RESULT)
    dim = max(size["dim"], 1)
    every = max(size["n"] // SAMPLE, 1)
    sample = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(every)) == 0).select("v").limit(2 * SAMPLE).collect()
    full = np.zeros((len(sample) + 1, dim))
    for i, r in enumerate(sample):
        full[i, :len(r["v"])] = r["v"]
    references = fit_references(np.floor(full * scale))
    prepared, path = store(_prepare(rows, dim, references, scale), "angles")

    width = len(references)
    ranges = prepared.groupBy("cell").agg(F.count("*").alias("n"), F.min("norm").alias("a"), F.max("norm").alias("z"),
                                          F.array(*[F.min(F.col("angles")[j]) for j in range(width)]).alias("least"),
                                          F.array(*[F.max(F.col("angles")[j]) for j in range(width)]).alias("most")).collect()
    chunk_rows = max(CHUNK_BYTES // (8 * (dim + width)), 256)
    cells = [(r["cell"], -(-r["n"] // chunk_rows), r["least"], r["most"], r["a"], r["z"]) for r in sorted(ranges, key=lambda r: r["cell"])]
    largest = max(c[5] for c in cells) ** 2
    if largest >= 2.0 ** 62:
        raise OverflowError("scores need more than 63 bits")
    wide = largest >= 2.0 ** 53
    counts = F.create_map(*[F.lit(x) for c in cells for x in c[:2]])
    placed = prepared.withColumns({"chunk": F.pmod(F.xxhash64("vec_id"), counts[F.col("cell")]).cast("int"), "key": F.xxhash64("label", "x")})
    n = partitions(spark)
    dealt = placed.repartition(n, "cell", "chunk").sortWithinPartitions("cell", "chunk", "vec_id", "key") \
        .mapInArrow(tidy(_chunks(dim, references, positives, wide)), WIRE)
    blocks, _ = store(dealt, "chunks")
    drop(spark, path)
    pieces = blocks.filter("kind = 0")

    def ask(questions: DataFrame, same: bool, k: int) -> DataFrame:
        return pieces.unionByName(questions.select(*_ARROW)).repartition(n, "cell", "chunk").sortWithinPartitions("cell", "chunk", "kind", "seq") \
            .mapInArrow(tidy(_answers(dim, references, same, k, wide)), WIRE)

    def sent(questions: DataFrame) -> DataFrame:
        return questions.select(*_ARROW).mapInArrow(tidy(_sent(dim, references, cells)), WIRE)

    questions = blocks.filter("kind = 1")
    whole_range = F.array(F.struct(F.lit(0).alias("no"), F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high")))
    at_home = blocks.filter("kind = 2")
    asked = _narrowed(questions.withColumn("wants", whole_range), _first(at_home, positives), positives)
    best, _ = store(_first(at_home.unionByName(ask(sent(asked), True, positives)), positives), "positives")

    # one want for each positive, numbered as it is; scores from ceil(low * p / 100) to floor(high * p / 100)
    p = F.col("score")
    want = F.struct(F.col("at").alias("no"), F.expr(f"-floor(-{low} * score / CAST(100 AS DECIMAL(20, 0)))").cast("long").alias("low"),
                    F.expr(f"floor({high} * score / CAST(100 AS DECIMAL(20, 0)))").cast("long").alias("high"))
    wants = best.withColumn("want", want).filter("want.low <= want.high").groupBy("anchor_id", "anchor_key").agg(F.sort_array(F.collect_list("want")).alias("wants"))
    asked, _ = store(questions.drop("wants").join(wants, ["anchor_id", "anchor_key"]), "questions")
    near, _ = store(_first(ask(asked, False, negatives), negatives), "negatives")
    others = ask(sent(_narrowed(asked, near, negatives)), False, negatives)
    final = _first(near.drop("at").unionByName(others.select("anchor_id", "anchor_key", "no", "score", "vec_id")), negatives)
    chosen = best.select("anchor_id", "anchor_key", F.col("at").alias("no"), F.col("vec_id").alias("positive_id"), p.alias("positive_score"))
    return chosen.join(final, ["anchor_id", "anchor_key", "no"]).select(
        "anchor_id", "positive_id", F.col("at").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
