"""Whitening of embeddings: distributed centred covariance, eigenpairs, broadcast projection.

Entries become integers, ``floor(scale * c) + offset``.

1. One pass gives the number of vectors and the sums of every dimension, exact.
2. A second pass takes the integer next to the mean off every entry and then
   multiplies, in integers; the rest of the mean, at most one half, comes off
   in exact arithmetic too.  So the covariance is right to the last bit, however
   far the entries lie from 0 and in whatever order tasks end.
3. Its leading eigenpairs come from :mod:`.symmetric_eigen`.
4. The projection, as wide as a vector, is broadcast.  A third pass measures
   the covariance of what it gives; a fourth returns it.

Each task sends one matrix, and these are added up in ``MERGERS`` tasks, so
the driver gets a number of matrices that does not grow with the input.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_analytics.llm.common import tidy
from ontime_analytics.llm.symmetric_eigen import leading_pairs

#: Vectors may have so many entries: a task holds one matrix of that width, the driver a few.
MAX_DIM = 2048
#: Integers beyond this are refused.
MAX_ENTRY = 1 << 40
MERGERS = 8
#: A component counts only if its eigenvalue exceeds this share of the largest; below, it is rounding.
LEAST_SHARE = 1e-9


@dataclass
class Whitening:
    """``n`` fitted vectors with ``sums`` per dimension; ``components`` as columns, by falling ``values``."""
    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    scale: float
    offset: int

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def usable(vector: Column) -> Column:
    """Neither null nor with null or non-finite entries."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def _rows(vectors: DataFrame, vector_col: str, keep: Column | None = None) -> DataFrame:
    v = vectors[vector_col].cast("array<double>")
    more = [] if keep is None else [keep.alias("row")]
    return vectors.filter(usable(v)).select(*more, v.alias("v"))


def _integers(column: pa.Array, scale: float, offset: int, dim: int | None = None) -> np.ndarray:
    """The vectors as a matrix of integers; shorter ones are filled up with zeros before they become integers."""
    ends = column.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(ends)
    width = int(sizes.max(initial=0)) if dim is None else dim
    if width > MAX_DIM:
        raise ValueError(f"vectors of {width} entries; at most {MAX_DIM} are taken")
    values = column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
    full = np.zeros((len(sizes), width))
    full[np.arange(width) < sizes[:, None]] = values
    full = np.floor(full * scale)
    if full.size and np.abs(full).max() > MAX_ENTRY:
        raise ValueError("an entry is too large")
    return full.astype(np.int64) + offset


def _packed(batches):
    """The column ``v`` of the batches, a few thousand vectors at a time."""
    for b in batches:
        for at in range(0, b.num_rows, 4096):
            yield b.slice(at, 4096)


def _batch(payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([payload], pa.binary())], ["payload"])


def _merged(parts: DataFrame, add) -> list[bytes]:
    """The payloads added up in a few tasks; so many payloads are left."""
    def run(batches):
        total = None
        for b in batches:
            for payload in b.column("payload"):
                total = payload.as_py() if total is None else add(total, payload.as_py())
        if total is not None:
            yield _batch(total)

    return [r["payload"] for r in parts.repartition(MERGERS).mapInArrow(tidy(run), "payload binary").collect()]


def _add_integers(a: bytes, b: bytes) -> bytes:
    x, y = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
    if max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) >= 1 << 62:
        raise OverflowError("the entries spread too widely for exact sums")
    return (x + y).tobytes()


def _add_spreads(a: bytes, b: bytes) -> bytes:
    """Two (count, mean, centred products) become one."""
    x, y = np.frombuffer(a), np.frombuffer(b)
    k = round((-1 + (1 + 4 * (len(x) - 1)) ** 0.5) / 2)
    n, m = x[0], y[0]
    d = y[1:k + 1] - x[1:k + 1]
    products = x[k + 1:] + y[k + 1:] + np.outer(d, d).reshape(-1) * (n * m / (n + m))
    return np.concatenate([[n + m], x[1:k + 1] + d * (m / (n + m)), products]).tobytes()


def fit(vectors: DataFrame, components: int = 32, vector_col: str = "embedding", scale: float = 64, offset: int = 1_000_000) -> Whitening | None:
    """The whitening of all usable vectors; None if there is none.

    Null vectors and those with null or non-finite entries take no part; a
    shorter vector counts as if its missing entries were 0; repeated rows each
    count.  Components whose eigenvalue is below ``LEAST_SHARE`` of the largest
    (all, if the vectors are all alike) are left out.  Vectors of more than
    ``MAX_DIM`` entries, and entries too large for exact integers, are refused."""
    rows = _rows(vectors, vector_col)

    def totals(batches):
        n, sums = 0, np.zeros(0, np.int64)
        for b in _packed(batches):
            x = _integers(b.column("v"), scale, 0)
            n += len(x)
            s = x.sum(axis=0)
            if len(s) > len(sums):
                s, sums = sums, s
            sums = sums.copy()
            sums[:len(s)] += s
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.int64()))], ["n", "sums"])

    each = rows.mapInArrow(tidy(totals), "n long, sums array<long>")
    found = each.select("n", F.posexplode_outer("sums")).groupBy("pos") \
        .agg(F.sum("col").alias("s"), F.sum(F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("n"))).alias("n")).collect()
    n = sum(r["n"] or 0 for r in found)
    if not n:
        return None
    sums = {r["pos"]: r["s"] for r in found if r["pos"] is not None}
    dim = len(sums)
    sums = [sums[i] + n * offset for i in range(dim)]
    if not dim:
        return Whitening(n, [], np.zeros(0), np.zeros((0, 0)), 0.0, scale, offset)
    middle = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]

    def products(batches):
        total = np.zeros((dim, dim), np.int64)
        seen = False
        pivot = np.array(middle, np.int64)
        for b in _packed(batches):
            y = _integers(b.column("v"), scale, offset, dim) - pivot
            most = float(np.abs(y).max(initial=0)) ** 2 * len(y)
            if most >= 2.0 ** 62:
                raise OverflowError("the entries spread too widely for exact sums")
            f = y.astype(float)
            total = np.frombuffer(_add_integers(total.tobytes(), ((f.T @ f).astype(np.int64) if most < 2.0 ** 53 else y.T @ y).tobytes()), np.int64).reshape(dim, dim)
            seen = True
        if seen:
            yield _batch(total.tobytes())

    total = [0] * (dim * dim)
    for payload in _merged(rows.mapInArrow(tidy(products), "payload binary"), _add_integers):
        total = [a + b for a, b in zip(total, np.frombuffer(payload, np.int64).tolist())]
    # n^2 times the covariance is n * products - rest rest', an integer
    v = np.array([(n * total[i * dim + j] - rest[i] * rest[j]) / (n * n) for i in range(dim) for j in range(dim)]).reshape(dim, dim)
    trace = sum(n * total[i * dim + i] - rest[i] ** 2 for i in range(dim)) / (n * n)
    values, columns = leading_pairs(v, components)
    good = values > LEAST_SHARE * max(float(values[0]), 0.0)
    return Whitening(n, sums, values[good], columns[:, good], trace, scale, offset)


def _projector(vectors: DataFrame, model: Whitening):
    """For tasks: (n * x - sums as exact integers or None if they need more than 63 bits, whitened) of a batch."""
    n, dim = model.n, len(model.sums)
    middle = [(2 * s + n) // (2 * n) for s in model.sums]
    shared = vectors.sparkSession.sparkContext.broadcast((
        np.array(middle, np.int64), [s - n * m for s, m in zip(model.sums, middle)], model.components / np.sqrt(model.values)))
    scale, offset = model.scale, model.offset

    def project(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pivot, rest, matrix = shared.value
        y = _integers(column, scale, offset, dim) - pivot
        return y, (y - np.array([r / n for r in rest])) @ matrix

    def deviation(y: np.ndarray) -> list[int]:
        _, rest, _ = shared.value
        if (n * (float(np.abs(y).max(initial=0)) + 1)) ** 2 * max(dim, 1) < 2.0 ** 62:
            d = n * y - np.array(rest, np.int64)
            return (d * d).sum(axis=1).tolist()
        d = n * y.astype(object) - np.array(rest, object)
        return [int(s) for s in (d * d).sum(axis=1)]

    return project, deviation


def identity_error(vectors: DataFrame, model: Whitening, vector_col: str = "embedding") -> float | None:
    """The largest entry, without sign, of the whitened vectors' covariance minus the identity, measured over all of
    them: every batch is centred on its own mean, and batches are merged with what their means differ.  None without components."""
    k = len(model.values)
    if not k:
        return None
    project, _ = _projector(vectors, model)

    def spreads(batches):
        total = None
        for b in _packed(batches):
            _, w = project(b.column("v"))
            if len(w):
                mean = w.mean(axis=0)
                c = w - mean
                part = np.concatenate([[float(len(w))], mean, (c.T @ c).reshape(-1)]).tobytes()
                total = part if total is None else _add_spreads(total, part)
        if total is not None:
            yield _batch(total)

    total = None
    for part in _merged(_rows(vectors, vector_col).mapInArrow(tidy(spreads), "payload binary"), _add_spreads):
        total = part if total is None else _add_spreads(total, part)
    x = np.frombuffer(total)
    return float(np.abs(x[k + 1:].reshape(k, k) / x[0] - np.eye(k)).max())


def whiten(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector: ``vec_id, deviation, whitened``.

    ``deviation`` is the exact sum over dimensions of ``(n * x - sum)**2`` (a job
    fails rather than give one that a long cannot hold); ``whitened`` has one
    double per component.  Null and repeated ids keep their rows, other columns
    are ignored, an empty table gives no rows."""
    project, deviation = _projector(vectors, model)

    def run(batches):
        for b in _packed(batches):
            y, w = project(b.column("v"))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(deviation(y), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.reshape(-1)))],
                ["vec_id", "deviation", "whitened"])

    rows = _rows(vectors, vector_col, vectors[id_col].cast("long"))
    return rows.mapInArrow(tidy(run), "vec_id long, deviation long, whitened array<double>")
