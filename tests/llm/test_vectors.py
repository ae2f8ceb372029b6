"""Hard negatives and whitening against plain versions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ontime_analytics.llm import hard_negatives, whitening
from ontime_analytics.llm.catalog import QUERIES
from ontime_analytics.llm.hard_negatives import bounds, fit_references, mine_hard_negatives, slack
from ontime_analytics.llm.symmetric_eigen import leading_pairs

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, label string, embedding array<float>, cell string, chunk string, n string, deviation string, whitened string"
NAN, INF = float("nan"), float("inf")


def plain_negatives(rows, scale=256, positives=5, negatives=10, every=100):
    """[(id, label, vector)] -> the result's rows."""
    good = {(i, t, tuple(v)) for i, t, v in rows if i is not None and t is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    width = max((len(v) for _, _, v in good), default=0)
    ints = [(i, t, [int(np.floor(scale * float(np.float32(x)))) for x in v] + [int(np.floor(0.0))] * (width - len(v))) for i, t, v in good]
    out = []
    for i, t, v in ints:
        if i % every:
            continue
        score = lambda w: sum(a * b for a, b in zip(v, w))  # noqa: B023, E731
        best = sorted((-score(w), j) for j, u, w in ints if u == t and j != i)[:positives]
        for s, p in best:
            found = sorted((-score(w), j) for j, u, w in ints if u != t and 30 * -s <= 100 * score(w) <= 90 * -s)[:negatives]
            out += [(i, p, k + 1, j, -s, -n) for k, (n, j) in enumerate(found)]
    return sorted(out)


def mined(df, **more):
    return sorted(map(tuple, mine_hard_negatives(df, F.col("vec_id") % 100 == 0, **more).collect()))


def vectors(n, dim=6, seed=1, labels=3):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(labels, dim))
    return [(int(i), str(i % labels), (middle[i % labels] + 0.4 * r.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


def table(write, rows):
    return write([(*r, "x", "y", "z", "u", "w") for r in rows], SCHEMA)


@pytest.mark.parametrize("chunk_bytes", [hard_negatives.CHUNK_BYTES, 1])
def test_hard_negatives_as_plain(write, monkeypatch, chunk_bytes):
    """Also with ties, copies, a hot vector, and cells cut into many chunks."""
    monkeypatch.setattr(hard_negatives, "CHUNK_BYTES", chunk_bytes)
    rows = vectors(1200)
    rows += [(5000 + i, str(i % 3), rows[100][2]) for i in range(600)]  # a third of all rows are one vector
    rows += rows[:3]
    assert mined(table(write, rows)) == plain_negatives(rows)


def test_hard_negatives_odd_rows(write):
    rows = [(0, "a", [1.0, 0.5]), (0, "b", [0.9, 0.4]), (1, "a", [1.0, 0.5]), (1, "a", [1.0, 0.5]), (2, "b", [0.5, 0.25]), (3, "b", [0.5]), (4, "b", []),
            (5, None, [1.0, 1.0]), (None, "a", [1.0, 1.0]), (6, "b", None), (7, "b", [1.0, None]), (8, "b", [NAN, 1.0]), (9, "b", [INF, 1.0]),
            (100, "c", [0.0, 0.0]), (101, "c", [1.0, -1.0]), (200, "d", [-1.0, -1.0]), (201, "d", [1.0, 1.0]), (-100, "b", [1.0, 1.0])]
    got = mined(table(write, rows))
    assert got == plain_negatives(rows) and got
    assert mined(table(write, rows[:1])) == [] and mined(table(write, [])) == []
    with pytest.raises(Exception, match="too large"):
        mined(table(write, [(0, "a", [1e30])]))


def test_wide_scores_are_exact(write):
    r = np.random.default_rng(4)
    rows = [(i * 50, "ab"[i % 2], (r.integers(1 << 23, 1 << 24, 4)).astype(float).tolist()) for i in range(40)]
    assert mined(table(write, rows), scale=4) == plain_negatives(rows, scale=4)


def test_bounds_hold():
    r = np.random.default_rng(2)
    x = np.floor(256 * r.normal(size=(500, 8)))
    x[7], x[8] = x[6], -x[6]
    references = fit_references(x[:100], 5)
    norms, angles = hard_negatives._angles(x.astype(np.int32), references)
    for i in range(0, 60):
        low, high = bounds(norms[i], angles[i], norms, angles, slack(8))
        scores = x @ x[i]
        assert (low <= scores).all() and (scores <= high).all()


def test_bounds_leave_rows_out(write, monkeypatch):
    """Only rows whose interval meets a window are scored."""
    r = np.random.default_rng(3)
    middle = np.eye(8)
    x = np.floor(256 * (middle[np.arange(2000) % 8] + 0.05 * r.normal(size=(2000, 8)))).astype(np.int32)
    references = fit_references(x[:200].astype(float), 8)
    norms, angles = hard_negatives._angles(x, references)
    best = np.sort(x.astype(float) @ x[0])[-6]
    _, high = bounds(norms[0], angles[0], norms, angles, slack(8))
    assert (high >= best).mean() < 0.3


def test_query_of_hard_negatives(spark):
    rows = [(r["vec_id"], None if r["label"] is None else str((r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]), r["embedding"])
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op11_hard_negatives"](spark, SF)
    assert [f"{n} {t}" for n, t in got.dtypes] == ["anchor_id bigint", "positive_id bigint", "rank int", "negative_id bigint", "positive_score bigint", "negative_score bigint"]
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)


# ---- whitening

def plain_whitening(vs, k, scale=64, offset=1_000_000):
    x = np.floor(scale * np.array(vs, np.float32).astype(float)).astype(np.int64) + offset
    n, s = len(x), x.sum(axis=0)
    z = (n * x - s) / n
    v = z.T @ z / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(axis=1), z @ q / np.sqrt(e), e / np.trace(v)


def test_eigenpairs():
    r = np.random.default_rng(1)
    a = r.normal(size=(40, 40))
    q = np.linalg.qr(a)[0]
    for values in (np.linspace(50, 1, 40), np.r_[[9.0] * 5, [4.0] * 30, np.zeros(5)], np.zeros(40), np.r_[1e6, 1 + 1e-13 * np.arange(39)]):
        m = (q * values) @ q.T
        m = (m + m.T) / 2
        got, vectors = leading_pairs(m, 12)
        size = max(np.abs(values).max(), 1)
        assert np.allclose(got, np.sort(values)[::-1][:12], atol=1e-12 * size)
        assert np.abs(vectors.T @ vectors - np.eye(12)).max() < 1e-12
        assert np.abs(m @ vectors - vectors * got).max() < 1e-12 * size
    got, vectors = leading_pairs(np.diag([3.0, 1.0, 2.0]), 5)
    assert got.tolist() == [3.0, 2.0, 1.0] and np.abs(np.abs(vectors) - np.eye(3)[:, [0, 2, 1]]).max() < 1e-12
    assert leading_pairs(np.array([[7.0]]), 3)[0].tolist() == [7.0]


def test_query_of_whitening(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    n, deviation, white, explained = plain_whitening([r["embedding"] for r in rows], 32)
    got = QUERIES["op12_embedding_whitening"](spark, SF)
    assert [f"{a} {t}" for a, t in got.dtypes] == ["vec_id bigint", "component int", "n bigint", "deviation bigint", "whitened double", "explained double", "identity_error double"]
    found = {(r["vec_id"], r["component"]): r for r in got.collect()}
    assert len(found) == 32 * n
    signs = [np.sign(sum(found[r["vec_id"], c + 1]["whitened"] * w[c] for r, w in zip(rows, white))) for c in range(32)]
    for r, d, w in zip(rows, deviation, white):
        for c in range(32):
            f = found[r["vec_id"], c + 1]
            assert (f["n"], f["deviation"]) == (n, d) and abs(f["whitened"] - signs[c] * w[c]) < 1e-9
            assert abs(f["explained"] / explained[c] - 1) < 1e-9 and 0 <= f["identity_error"] < 1e-9


def test_whitening_odd_rows(write, spark):
    rows = vectors(200, dim=4)
    odd = [(None, "a", rows[0][2]), (rows[1][0], "a", rows[1][2]), (300, None, rows[2][2]), (301, "a", None), (302, "a", [NAN, 0.0, 0.0, 0.0]),
           (303, "a", [None, 0.0, 0.0, 0.0]), (304, "a", [-INF, 0.0, 0.0, 0.0]), (305, "a", [1.0]), (306, "a", [])]
    used = [v for _, _, v in rows] + [odd[0][2], odd[1][2], odd[2][2], [1.0, 0, 0, 0], [0.0] * 4]
    df = table(write, rows + odd)
    model = whitening.fit(df, 3)
    got = whitening.whiten(df, model).collect()
    n, deviation, white, _ = plain_whitening(used, 3)
    assert model.n == n and sorted(r["deviation"] for r in got) == sorted(deviation.tolist())
    assert sorted(str(r["vec_id"]) for r in got) == sorted([*(str(r[0]) for r in rows), "None", "1", "300", "305", "306"])
    assert np.allclose(np.sort(np.abs([r["whitened"] for r in got]), axis=0), np.sort(np.abs(white), axis=0))
    assert whitening.identity_error(df, model) < 1e-9


def test_whitening_without_spread(write):
    same = table(write, [(i, "a", [0.5, 0.25]) for i in range(9)])
    model = whitening.fit(same)
    assert len(model.values) == 0 and whitening.identity_error(same, model) is None
    assert [(r["deviation"], r["whitened"]) for r in whitening.whiten(same, model).collect()] == [(0, [])] * 9
    assert whitening.fit(table(write, [])) is None
    line = table(write, [(i, "a", [float(i), 2.0 * i, 1.0]) for i in range(50)])
    assert len(whitening.fit(line).values) == 1
    with pytest.raises(Exception, match="too large"):
        whitening.fit(table(write, [(1, "a", [1e30, 1.0])]))


def test_whitening_far_from_zero(write):
    """An offset a million million times the spread changes nothing."""
    rows = table(write, vectors(300, dim=4))
    near, far = whitening.fit(rows, 4, offset=0), whitening.fit(rows, 4, offset=10 ** 12)
    assert near.values.tolist() == far.values.tolist() and near.components.tolist() == far.components.tolist()


def test_merged_spreads():
    r = np.random.default_rng(6)
    parts = [r.normal(size=(n, 3)) + 5 for n in (4, 1, 70)]
    pack = lambda x: np.concatenate([[len(x)], x.mean(axis=0), ((x - x.mean(axis=0)).T @ (x - x.mean(axis=0))).reshape(-1)]).tobytes()
    got = pack(parts[0])
    for p in parts[1:]:
        got = whitening._add_spreads(got, pack(p))
    assert np.allclose(np.frombuffer(got), np.frombuffer(pack(np.concatenate(parts))))
