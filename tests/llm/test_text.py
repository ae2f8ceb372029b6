"""Toxicity, URL rules, chat, decontamination, BPE, token counts, secrets, the pipeline, the driver's queries."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from odd_rows import ODD_ROWS
from tokenizers import Tokenizer

import corpus_pipeline
from ontime_analytics.llm import bpe_codec, catalog, chat, decontaminate, secrets_scan, toxicity
from ontime_analytics.llm.token_counts import count_tokens
from ontime_analytics.llm.url_filter import judge_urls

SF = "/root/testdata/sf0.001"
SPACES = " \n\t\r\x0b\x0c\x85\xa0   \x1c\0'sta1½é,.<|>😀"


@pytest.fixture(scope="module")
def tokenizer(tokenizer_path):
    return Tokenizer.from_file(tokenizer_path)


# ---- SQL ----

@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got = catalog.QUERIES[name](spark, SF)
    rel = con.sql(catalog.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(rel.columns)
    assert Counter(tuple(r[c] for c in rel.columns) for r in got.collect()) == Counter(rel.fetchall())


# ---- toxicity ----

def test_ordinal_fit_orders_grades():
    r = random.Random(2)
    rows, grades = [], []
    for _ in range(900):
        g = r.choice([0, 0, 0, 1, 2])
        rows.append(sorted({r.randrange(100, 400) for _ in range(20)} | set(r.sample(range(10), 4 * g))))
        grades.append(g)
    m = toxicity.fit(rows[:600], grades[:600], 3)
    assert m.thresholds == sorted(m.thresholds) and {f for f, w in m.weights.items() if w > 1} <= set(range(10))
    p = m.above(np.array([sum(m.weights.get(f, 0) for f in x) for x in rows[600:]]))
    assert (p[:, 0] >= p[:, 1]).all()
    severity = p.sum(1)
    mean = [np.mean([s for s, g in zip(severity, grades[600:]) if g == k]) for k in range(3)]
    assert mean[0] < 0.3 < mean[1] < mean[2]


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = toxicity.score(docs, toxicity.train(docs, labels.filter("doc_id % 2 = 0"))).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    n = Counter((x.toxic, x.rejected) for x in out)
    assert n[1, True] / (n[1, True] + n[1, False]) > 0.85
    assert n[0, True] / (n[0, True] + n[0, False]) < 0.01


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (7, 0), (None, 1), (3, None), (9, 0), (9, 1)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    assert Counter(x.doc_id for x in toxicity.score(odd, model).collect()) == Counter(d for d, _ in ODD_ROWS)
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.train(empty, labels.limit(0))
    assert none.weights == {} and not any(x.rejected for x in toxicity.score(odd, none).collect())


def test_toxicity_labels_beyond_docs(write, empty):
    """The sample is taken from the labels that have a document; without any there is a warning."""
    r = random.Random(23)
    word = lambda: "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(3))
    docs = write([(i, " ".join(word() for _ in range(20)) + (" vile scum" if i % 4 == 0 else "")) for i in range(80)], "doc_id long, text string")
    labels = write([(i, int(i % 4 == 0)) for i in range(4000)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, max_rows=80)
    assert model.weights and model == toxicity.train(docs, labels.filter("doc_id < 80"), max_rows=80)
    with pytest.warns(UserWarning, match="no document has a label"):
        assert not toxicity.train(docs, labels.filter("doc_id >= 80"), max_rows=80).weights


# ---- URLs ----

RULES = [(*r,) for r in catalog.URL_RULES] + [("b.com", "/x", "block"), ("b.com", "/x", "allow"), ("a.b.com", "/", "allow")]
URLS = [(1, "HTTP://WWW.Example.com/en/a?x=/"), (2, "http://example.com/en"), (3, "https://example.com/en/"), (4, None), (5, ""), (6, "no scheme"),
        (7, "ftp://net"), (8, "x://a.net/fr/1#/2"), (8, "x://a.net/fr/1#/2"), (None, "://.com/"), (9, "http://badexample.com/en/"),
        (10, "http://u:p@a.b.com:80/x"), (11, "http://a.b.com/x"), (12, "a://b://com/x"), (13, "http://com/" + "y" * 50_000),
        (14, "http://" + "a." * 3000 + "net/es/"), (15, "http://b.com/xyz"), (16, "http://net?/es/")]


def plain_judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[3]) if fits else (host, path, None, default)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"prefix_chars": 1}])
def test_urls(spark, options):
    pages = spark.createDataFrame([(i, u, "c") for i, u in URLS], "page_id long, url string, digest string")
    got = judge_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"), **options).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *plain_judge(u, RULES)) for i, u in URLS)


def test_urls_empty_and_bad_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {(r.rule, r.verdict) for r in judge_urls(pages, none, default="block").collect()} == {(None, "block")}
    assert judge_urls(pages.limit(0), none).count() == 0
    with pytest.raises(Exception, match="bad url rule"):
        judge_urls(pages, spark.createDataFrame([("com", "x", "allow")], "host string, path string, verdict string")).collect()


# ---- chat ----

def turns(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, segments string")


def test_chat_round_trip(spark):
    marks = chat.LLAMA_LIKE.controls()
    r = random.Random(8)
    pieces = [*marks, "\\", "\\\\", "[", "<", "]", ">", "\n", "é", "😀", "x", "/", "INST]", "s>", "SYS>>", "$1", ""]
    rows = [(c, t, r.choice(["system", "user", "assistant", "tool", "", None, "[/ROLE]\\"]), "".join(r.choice(pieces) for _ in range(r.randrange(12))))
            for c in range(150) for t in range(r.randrange(1, 6))]
    rows += [(500, 0, "user", None), (500, 0, "user", None), (None, 3, "user", "a"), (501, 1, "assistant", "b"), (501, None, "user", "q"),
             (502, 0, "user", "long " * 50_000)]
    out = chat.format_conversations(turns(spark, rows))
    got = out.select("conv_id", "n_turns", chat.read_turns(chat.formatted_text(out["segments"])).alias("turns"),
                     chat.loss_text(out["segments"]).alias("loss")).collect()
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert len(got) == len(want)
    for x in got:
        said = [(role, text) for _, _, role, text in sorted(want[x.conv_id])]
        assert [(t.role, t.text) for t in x.turns] == said and x.n_turns == len(said)
        assert x.loss == "".join(text for role, text in said if role == "assistant")


def test_chat_machine(spark):
    seqs = {1: "ua", 2: "sua", 3: "u", 4: "au", 5: "uaua", 6: "uu", 7: "usa", 8: "uas", 9: "s", 10: "t"}
    names = {"u": "user", "a": "assistant", "s": "system", "t": "tool"}
    out = chat.format_conversations(turns(spark, [(c, i, names[x], "") for c, q in seqs.items() for i, x in enumerate(q)])).collect()
    assert {x.conv_id: x.bad_turn for x in out if not x.valid} == {3: 1, 4: 0, 6: 1, 7: 1, 8: 2, 9: 1, 10: 0}
    assert chat.format_conversations(turns(spark, [])).count() == 0


def test_chat_bad_template():
    with pytest.raises(ValueError):
        chat.Template(begin="\\s").controls()


# ---- decontamination ----

ITEMS = [(1, "What is the tallest mountain on the whole of the earth today? Mount Everest stands above all the others there."),
         (2, "Alpha beta gamma delta. Epsilon zeta eta theta iota."), (3, None), (4, ""), (5, "short one"), (None, "Kappa lambda mu nu xi omicron pi rho sigma tau.")]


def test_wand_is_exact():
    r = random.Random(6)
    texts = [(i, " ".join(f"w{int(r.random() ** 2 * 300)}" for _ in range(r.randrange(3, 40)))) for i in range(150)]
    df = Counter(w for _, t in texts for w in set(decontaminate.words(t)))
    index = decontaminate.build_index(texts, df, len(texts), 20.0, common=0.1)
    docs = [decontaminate.words(" ".join(f"w{int(r.random() ** 2 * 400)}" for _ in range(r.randrange(400)))) for _ in range(40)]
    docs += [docs[0] + decontaminate.words(t) + docs[1] for _, t in texts[:30]]
    hot = set(decontaminate.candidates(index, docs, 0.6))
    hits = 0
    for d, ws in enumerate(docs):
        for start in range(0, max(1, len(ws)), index.window):
            q = sorted({t for t in map(index.terms.get, ws[start:start + 2 * index.window]) if t is not None})
            score = Counter()
            for t in q:
                for k, s in zip(index.items[t], index.scores[t]):
                    score[k] += s
            for least in (0.3, 0.6):
                found = dict(decontaminate.wand(index, q, least))
                assert set(found) == {k for k, s in score.items() if s >= least - 1e-9}
                assert all(abs(found[k] - score[k]) < 1e-9 for k in found)
            if any(s >= 0.6 for s in score.values()):
                hits += 1
                assert (d, start) in hot
    assert hits >= 30


@pytest.mark.parametrize("group", [1024, 2])
def test_leaks(spark, odd, empty, monkeypatch, group):
    monkeypatch.setattr(decontaminate, "GROUP_ITEMS", group)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    filler = "so many other words stand here and there in between " * 40
    rows = [(1, filler + ITEMS[0][1] + filler), (2, ITEMS[1][1].upper().replace(" ", "!! ")), (3, filler), (4, "Alpha beta gamma delta."),
            (5, ITEMS[5][1] + " " + ITEMS[1][1]), (5, None), (None, "short  ONE"), (6, "the earth is the whole of it today")]
    got = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), items, keep=["doc_id"]).collect()
    assert Counter((x.doc_id, tuple(sorted(str(h.item_id) for h in x.leaks))) for x in got) == Counter(
        {(1, ("1",)): 1, (2, ("2",)): 1, (3, ()): 1, (4, ()): 1, (5, ("2", "None")): 1, (5, ()): 1, (None, ("5",)): 1, (6, ()): 1})
    assert not any(x.leaks for x in decontaminate.find_leaks(odd, items, keep=["doc_id"]).collect())
    assert decontaminate.find_leaks(empty, items, keep=["doc_id"]).count() == 0
    assert decontaminate.find_leaks(odd, items.limit(0), keep=["doc_id"]).count() == len(ODD_ROWS)


# ---- BPE ----

def token_rows():
    r = random.Random(3)
    rows = ODD_ROWS + [(50, "  a  b\n\n c\t d  x\x1cy\x85z "), (51, "x<|endoftext|> y<|endoftext|>"), (52, "a\0b \0 c"), (53, "\n\n\n"), (54, " lead"),
                       (55, "it's I'll  don't  ok 1234 ½ x y"), (56, "\r\n a\r\n\r\nb"), (57, "x" * 30_000 + " y")]
    return rows + [(100 + k, "".join(r.choice(SPACES) for _ in range(r.randrange(60)))) for k in range(200)]


def test_codec(write, tokenizer, tokenizer_path, monkeypatch, empty):
    monkeypatch.setattr(bpe_codec, "BLOCK_BYTES", 3000)
    rows = token_rows()
    out = bpe_codec.decode(bpe_codec.encode(write(rows, "doc_id long, text string"), tokenizer_path), tokenizer_path).collect()
    want = Counter()
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want[d, np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((x.doc_id, bytes(x.ids), x.decoded) for x in out) == want
    assert Counter(x.decoded for x in out) == Counter(t or "" for _, t in rows)
    assert bpe_codec.encode(empty, tokenizer_path).count() == 0


def test_decode_any_ids(spark, tokenizer, tokenizer_path):
    """Ids that no text gives: cut characters become the replacement character, as in the library."""
    r = random.Random(9)
    lists = [[r.randrange(50257) for _ in range(r.randrange(30))] for _ in range(60)] + [[50256], []]
    rows = [(i, bytearray(np.array(x, "<u4").tobytes())) for i, x in enumerate(lists)] + [(999, None)]
    out = {x.n: x.decoded for x in bpe_codec.decode(spark.createDataFrame(rows, "n long, ids binary"), tokenizer_path).collect()}
    assert out.pop(999) == ""
    assert out == {i: tokenizer.decode(x, skip_special_tokens=False) for i, x in enumerate(lists)}


def test_counts(write, tokenizer, tokenizer_path, empty):
    rows = token_rows()
    out = count_tokens(write(rows, "doc_id long, text string"), tokenizer_path, limit=10, table_size=20, cache_size=30).collect()
    n = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    assert Counter(tuple(x) for x in out) == Counter((d, len((t or "").encode()), k, k > 10) for (d, t), k in zip(rows, n))
    assert count_tokens(empty, tokenizer_path).count() == 0


# ---- secrets ----

def test_secrets(spark, odd, empty):
    key = "9fQ2xLr7ZpW4tKd8Vb3nYc6M"
    rows = [(1, f"password = \"{key}\" and AKIA{'A1' * 9} é 0123456789abcdef0"), (2, None), (3, "token: short"), (4, f"the bearer {key} opens"),
            (5, "key: the-quick-brown-fox-jumps-over"), (6, f"nothing near {key}"), (7, "paſſword=abcdefghijklmnop toKen='abcdefghijkl'"),
            (8, "secretsecret:aaaaaaaaaaaa AKIAAKIA" + "0" * 10), (8, "deadbeefdeadbeefx" * 500)]
    got = {}
    for x in secrets_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(x.doc_id, []).append([(f.kind, f.start, f.end) for f in x.findings])
    assert got[1] == [[("assign", 0, 36), ("access", 42, 64), ("hex", 67, 84)]]
    assert got[2] == got[3] == got[5] == got[6] == [[]]
    assert got[4] == [[("novel", 11, 35)]]
    assert [f[0] for f in got[7][0]] == ["assign"]
    assert len(got[8][0] + got[8][1]) == 502
    assert secrets_scan.scan_secrets(odd).count() == len(ODD_ROWS)
    assert secrets_scan.scan_secrets(empty).count() == 0


def test_secret_base_patterns():
    r = random.Random(11)
    parts = ["password", "Token", "API_KEY", "apikey", "=", ":", " ", "'", '"', "abcdef0123456789", "AKIA", "ABCDEFGH12345678", "é", "\n", "xyz/+=", "secret"]
    plain = {"assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
             "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 16)}
    for _ in range(400):
        t = "".join(r.choice(parts) for _ in range(r.randrange(30)))
        assert sorted(secrets_scan.base_spans(t)) == sorted((k, m.start(), m.end()) for k, (p, ok) in plain.items() for m in re.finditer(p, t) if ok(m))


def test_secret_novelty():
    assert secrets_scan.marginal_bytes("9fQ2xLr7ZpW4tKd8Vb3nYc6M", "") > 20
    assert secrets_scan.marginal_bytes("authorization_header_value", "authorization header = authorization_header_value") < 0.7 * 26


def test_secret_any_alphabet_and_length(spark):
    """Random tokens of any alphabet and length are reported; long words, identifiers, paths and rulers are not."""
    import string

    r, hexes = random.Random(17), "0123456789ABCDEF"
    keys = ["qzvbtkwmxhrdplfn", "bearer-token-qzvbtkwmxhrdplfn", "QZVB-TKWM-XHRD-PLFN"]
    keys += ["".join(r.choice(al) for _ in range(n)) for al in (string.ascii_lowercase, string.ascii_letters, string.digits, hexes, string.ascii_letters + string.digits + "+/")
             for n in (16, 31, 64, 128, 300, 1000) for _ in range(5)]
    words = ["the-quick-brown-fox-jumps-over", "connection_pool_settings", "HTTPServerFactory", "/etc/service/config/default", "Haftpflichtversicherungen",
             "-" * 40, "+-------+-----+------+", "=" * 200, "-=" * 50]
    prose = ["the pool and the Server", "a factory pool for etc", "Haftpflicht und Versicherungen", "haftpflicht: versicherungen, settings"] * 2
    rows = [(i, f"private key: {k}") for i, k in enumerate(keys)] + [(-1 - i, f"private key: {w}") for i, w in enumerate(words)] + [(10_000, p) for p in prose]
    out = {x.doc_id: [f.kind for f in x.findings] for x in secrets_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [k for i, k in enumerate(keys) if not out[i]] == []
    assert [w for i, w in enumerate(words) if out[-1 - i]] == []


# ---- pipeline ----

def test_pipeline(spark, tmp_path, tokenizer):
    """The stages' decisions against plain rules on a small corpus; odd columns pass through."""
    from brute import near_groups

    r = random.Random(13)
    word = lambda: "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randrange(2, 4)))
    rows = [(i, " ".join(word() for _ in range(60))) for i in range(80)]
    toxic = {i for i in range(40, 60)}
    rows = [(i, t + " vile scum" if i in toxic else t) for i, t in rows]
    item = " ".join(word() for _ in range(20)) + ". " + " ".join(word() for _ in range(8)) + "."
    rows += [(100, rows[0][1].upper()), (101, rows[1][1] + " end"), (102, rows[2][1] + " " + item), (103, None), (104, ""), (103, None), (None, "a b c")]
    spark.createDataFrame([(d, t, "x", "y", 1, "z") for d, t in rows],
                          "doc_id long, text string, lang string, source string, n_chars long, doc string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()

    left = [(d, t or "") for d, t in rows if d not in toxic]
    best = {}
    for d, t in left:
        k = t.lower()
        if k not in best or (d if d is not None else -1) > (best[k][0] if best[k][0] is not None else -1):
            best[k] = (d, t)
    left = list(best.values())
    groups = near_groups([(10 ** 9 if d is None else d, t) for d, t in left])
    left = [(d, t) for i, (d, t) in enumerate(left) if groups[i][1] == (10 ** 9 if d is None else d)]
    want = {d: t for d, t in left if d != 102}
    assert {x.doc_id for x in out} == set(want) and len(out) == len(want)
    assert 100 in want and 0 not in want and 101 not in want and 104 in want
    for x in out:
        ids = tokenizer.encode(want[x.doc_id], add_special_tokens=False).ids
        assert bytes(x.ids) == np.array(ids, "<u4").tobytes() and x.n_tokens == len(ids)
        assert x.decoded_sha256 == hashlib.sha256(want[x.doc_id].encode()).hexdigest()


def test_pipeline_empty(spark, tmp_path):
    for t, s in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"),
                 ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], s).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_query_is_there(spark):
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in catalog.QUERIES) == list(range(1, 14))
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)
