"""Exact, near and substring dedup against plain versions."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from brute import near_groups, remove_repeats as brute_repeats
from odd_rows import ODD_ROWS
from pyspark.sql import functions as F

from ontime_analytics.llm import bwt, common, minhash, repeats
from ontime_analytics.llm.components import components
from ontime_analytics.llm.exact_dedup import chunks, exact_duplicates


def lower(t):
    return (t or "").encode().lower()


def test_chunks_join_to_the_text():
    r = random.Random(3)
    texts = [b"", b"x", bytes(r.randrange(256) for _ in range(50_000)), b"ab" * 30_000, bytes(r.randrange(97, 110) for _ in range(9_000))]
    parts = list(chunks(texts))
    assert [b"".join(p) for p in parts] == texts
    assert all(len(c) <= 8192 for p in parts for c in p)
    # an insertion at the front changes only the first chunks
    moved = list(chunks([b"new words " + texts[2]]))[0]
    assert set(moved[3:]) <= set(parts[2])


@pytest.mark.parametrize("digest_bytes", [16, 1])
def test_exact_duplicates(odd, digest_bytes):
    r = random.Random(5)
    got = exact_duplicates(odd, digest_bytes=digest_bytes).collect()
    groups = {}
    for d, t in ODD_ROWS:
        groups.setdefault(lower(t), []).append(d)
    want = Counter((d, max((x for x in groups[lower(t)] if x is not None), default=None), len(groups[lower(t)]),
                    hashlib.sha256(lower(t)).hexdigest()) for d, t in ODD_ROWS)
    assert Counter((x.doc_id, x.keep_id, x.group_size, x.text_sha256) for x in got) == want
    kept = Counter(x.text_sha256 for x in got if x.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(x.doc_id == x.keep_id for x in got if x.kept)
    assert r


def test_exact_collisions(write):
    """One-byte digests: most chunks collide, texts are still told apart."""
    r = random.Random(1)
    rows = [(i, "".join(r.choice("abcdefgh ") for _ in range(r.randrange(4000)))) for i in range(60)]
    rows += [(100 + i, rows[i][1].upper()) for i in range(20)]
    got = exact_duplicates(write(rows, "doc_id long, text string"), digest_bytes=1).collect()
    assert {(x.doc_id, x.keep_id, x.group_size, x.kept) for x in got} == \
        {(i, i + 100 if i < 20 else i, 2 if i < 20 or i >= 100 else 1, not i < 20) for i, _ in rows}


def test_empty_tables(empty):
    assert exact_duplicates(empty).count() == 0
    assert minhash.near_duplicates(empty).count() == 0
    assert repeats.remove_repeats(empty).count() == 0


def near_rows():
    r = random.Random(7)
    base = [f"w{r.randrange(5000)}" for _ in range(120)]
    rows = []
    for k in range(160):
        x = list(base)
        for _ in range(r.randrange(30)):
            x[r.randrange(len(x))] = f"z{r.randrange(10 ** 6)}"
        rows.append((k, " ".join(x)))
    return rows + [(1000 + i, t) for i, t in enumerate(t for _, t in ODD_ROWS)]


def test_near_duplicates(write):
    rows = near_rows()
    got = minhash.near_duplicates(write(rows, "doc_id long, text string")).collect()
    want = near_groups(rows)
    assert Counter((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in got) == \
        Counter((rows[i][0], n, c, rows[i][0] == c) for i, (n, c) in want.items())


def test_near_duplicates_odd(odd):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD_ROWS)
    by = {}
    for x in got:
        by.setdefault(x.doc_id, set()).add((x.n_shingles, x.component_id, x.kept))
    assert by[2] == {(11, 1, False)} and by[1] == {(11, 1, True)}
    assert by[3] == {(0, 3, True)} and by[5] == {(0, 5, True)}
    assert by[None] == {(4, 6, False), (0, None, True)}
    assert by[11] == {(1, -3, False)} and by[7] == {(1, 7, True)}


def test_sketches_fill_and_estimate():
    r = np.random.default_rng(2)
    a = r.integers(0, 2 ** 63, 400, dtype=np.uint64)
    b = np.concatenate([a[:300], r.integers(0, 2 ** 63, 100, dtype=np.uint64)])
    s = minhash.sketches([a, b, a[:1], np.empty(0, np.uint64)])
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert not (s[:3] == top).any() and (s[3] == top).all()
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.15
    assert (minhash.sketches([a[::-1]])[0] == s[0]).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (95, 100), (200, 3), (3, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 200: 0, 90: 90, 95: 90, 100: 90}


def test_collection_suffixes():
    r = random.Random(1)
    for _ in range(40):
        alphabet = b"ab\x00\xffc"[:r.randrange(1, 6)]
        strs = [bytes(r.choice(alphabet) for _ in range(r.randrange(12))) for _ in range(r.randrange(1, 30))]
        sizes = np.array([len(s) for s in strs])
        who, size, lcp = bwt.collection_suffixes(np.frombuffer(b"".join(strs), np.uint8), np.cumsum(sizes) - sizes, sizes)
        rows = [strs[w][len(strs[w]) - n:] for w, n in zip(who, size)]
        assert rows == sorted(s[i:] for s in strs for i in range(len(s) + 1))

        def common(a, b):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            return n

        assert list(lcp) == [0] + [common(a, b) for a, b in zip(rows, rows[1:])]


@pytest.mark.parametrize("shares", [common.HOT_SHARES, 4, 10 ** 9])
def test_groups_join_whatever_is_hot(spark, monkeypatch, shares):
    """A key with a third of all rows, null keys, keys without a group, and a key too long to broadcast."""
    monkeypatch.setattr(common, "HOT_SHARES", shares)
    monkeypatch.setattr(common, "HOT_KEY_BYTES", 20)
    keys = ["hot"] * 400 + [None] * 100 + ["long" * 10] * 300 + [f"k{i % 50}" for i in range(400)] + ["lost"] * 5
    rows = spark.createDataFrame([(i, k, "x" if k != "k7" else None) for i, k in enumerate(keys)], "row long, k string, j string")
    groups = rows.filter("k is not null and k != 'lost'").groupBy("k").agg(F.count("*").alias("n"), F.min("row").alias("least")).withColumn("j", F.lit("x"))
    got = common.join_groups(rows, groups, ["k", "j"], "n", rows.count(), F.xxhash64("row"))
    want = {k: (keys.count(k), keys.index(k)) for k in set(keys)}
    assert got.columns == ["row", "k", "j", "n", "least"]
    assert sorted((r["row"], r["n"], r["least"]) for r in got.collect()) == [
        (i, *((None, None) if k in (None, "lost", "k7") else want[k])) for i, k in enumerate(keys)]


def test_pairs_across_components_miss_no_link(spark):
    """Round two: every similar pair of different components, whatever the components, one of which is large."""
    from brute import shingles

    from ontime_analytics.llm.common import store

    r = random.Random(15)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    texts = []
    for _ in range(6):
        base = [word() for _ in range(60)]
        for _ in range(12):
            own = list(base)
            for _ in range(r.randrange(4)):
                own[r.randrange(60)] = word()
            texts.append(" ".join(own))
    rows = [(i, r.choice([0, 0, 0, 0, 1, 2, i]), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "cls long, component long, text string")
    got = {tuple(x) for x in minhash._across(df, 75, lambda d, n: store(d, n)).collect()}
    sets = [shingles(t) for t in texts]
    linked = {(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
              if rows[i][1] != rows[j][1] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert linked and linked <= got
    assert all(a < b and rows[a][1] != rows[b][1] for a, b in got)


def repeat_rows():
    r = random.Random(4)
    passage = "".join(r.choice("abcdefgh ") for _ in range(300))
    noise = lambda: "".join(r.choice("xyzw ") for _ in range(r.randrange(80)))
    rows = []
    for k in range(200):
        a = r.randrange(200)
        rows.append((k, noise() + passage[a:a + r.randrange(30, 120)] + noise()))
    n = 1000
    rows += [(n, "a" * 500), (n + 1, "a" * 49), (n + 2, "a" * 50), (n + 3, "b" + "a" * 70 + "c"), (n + 4, "ab" * 200),
             (n + 5, "ba" * 100), (n + 5, "ab" * 60), (n + 5, "ab" * 61), (None, "ab" * 60), (-5, "é" * 100), (n + 6, "xé" * 3 + "é" * 40)]
    return rows + [(2000 + i, t) for i, (_, t) in enumerate(ODD_ROWS)]


@pytest.mark.parametrize("local_hot, hot", [(64, 4096), (2, 4)])
def test_remove_repeats(write, monkeypatch, local_hot, hot):
    """Small blocks, so that answers cross them; with low bounds the strings go one by one."""
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(repeats, "LOCAL_HOT", local_hot)
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = repeat_rows()
    got = repeats.remove_repeats(write(rows, "doc_id long, text string")).collect()
    plain = [(2 ** 62 if d is None else d, (t or "").encode()) for d, t in rows]
    want = Counter()
    for k, mask in brute_repeats(plain).items():
        b = plain[k][1]
        spans = sum(1 for i, m in enumerate(mask) if m and (i == 0 or not mask[i - 1]))
        want[rows[k][0], len(b), sum(mask), spans, bytes(x for x, m in zip(b, mask) if not m)] += 1
    assert Counter((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in got) == want


def test_remove_repeats_odd(odd):
    got = repeats.remove_repeats(odd).collect()
    assert Counter(x.doc_id for x in got) == Counter(d for d, _ in ODD_ROWS)
    long_ = {x.doc_id: x for x in got if x.doc_id in (9, 10)}
    assert long_[9].n_removed == 0 and long_[10].n_removed == 0  # the copy differs in case
