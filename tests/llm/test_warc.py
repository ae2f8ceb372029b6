"""WARC archives: written, read back, and against a plain version."""

from __future__ import annotations

import gzip
import hashlib
import os
import random
from collections import Counter

import pytest

from ontime_analytics.llm import warc
from ontime_analytics.llm.catalog import QUERIES
from ontime_analytics.llm.warc import WarcOptions, read_warc, write_warc

SCHEMA = "page_id long, url string, html string, shard string, digest string, at string, n string, parts string"
SMALL = WarcOptions(shard_bytes=20_000, roll_bytes=4_000)


def table(write, rows, partitions=3):
    return write([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA, partitions)


def expected(rows):
    """Counter of (page_id, url, bytes, digest, type, refers_to, payload)."""
    rows = [(i, u, (h or "").encode()) for i, u, h in rows]
    key = lambda r: ((r[0] is not None, r[0] or 0), (r[1] is not None, r[1] or ""))
    out, groups = Counter(), {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    for payload, group in groups.items():
        for at, (i, u, _) in enumerate(sorted(group, key=key)):
            again = at > 0 and len(payload) >= 100
            first = sorted(group, key=key)[0]
            out[i, None if u is None else warc.plain_uri(u), len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response",
                first[0] if again else None, None if again else payload] += 1
    return out


def found(df):
    return Counter((r["page_id"], r["target_uri"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
                    None if r["payload"] is None else bytes(r["payload"])) for r in df.collect())


def pages(n=300, seed=1):
    r = random.Random(seed)
    page = lambda k: f"<html>{k} " + " ".join(r.choice(["lorem", "ipsum", "ü", "日本", "\r\n\r\n", "WARC/1.1"]) for _ in range(r.randrange(400))) + "</html>"
    rows = [(i, f"http://h{i % 7}.example.com/{i}", page(i)) for i in range(n)]
    hot = "<p>" + "the same page " * 40
    rows += [(1000 + 3 * i, f"http://copy.example.com/{i}", hot) for i in range(n // 2)]  # a third of all rows
    rows += [(2000 + i, "http://x/", "short") for i in range(5)] + [(3000, "http://x/", "y" * 99), (3001, "http://x/", "y" * 99), (3002, "http://x/", "y" * 100), (3003, "http://x/", "y" * 100)]
    rows += [(None, None, hot), (None, "u", None), (4000, None, ""), (-5, "http://neg/\r\nX: y \x00é", hot), (10 ** 17, "far", "z" * 500)]
    rows += [(7, "http://alike/", "w" * 300)] * 3 + [(8, "http://alike/", "w" * 300)] * 2 + [(9, "http://p/", "q" * 5000)] * 2
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [SMALL, WarcOptions()])
def test_written_and_read_back(write, spark, tmp_path, options):
    rows = pages()
    manifest = write_warc(table(write, rows), str(tmp_path / "w"), options).collect()
    got = read_warc(spark, str(tmp_path / "w"))
    assert found(got) == expected(rows)
    ids = [r["record_id"] for r in got.select("record_id").collect()]
    assert len(set(ids)) == len(ids) == sum(m["records"] for m in manifest)
    refers = {r["refers_to_id"] for r in got.collect() if r["refers_to_id"]}
    stored = {r["record_id"] for r in got.collect() if r["record_type"] == "response"}
    assert refers <= stored
    names = sorted(m["name"] for m in manifest)
    assert sorted(f for f in os.listdir(tmp_path / "w") if f.endswith(".gz")) == names and not (tmp_path / "w" / "_temporary").exists()
    if options is SMALL:
        assert len(names) > 5
        for m in manifest:  # a file is closed by the record that fills it
            assert m["bytes"] < 4_000 + 3_000
    for m in manifest:
        data = (tmp_path / "w" / m["name"]).read_bytes()
        assert hashlib.sha256(data).hexdigest() == m["sha256"] and gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_shards_are_ranges(write, spark, tmp_path):
    rows = [(i, "u", f"{i} " * 100) for i in range(500)]
    write_warc(table(write, rows), str(tmp_path / "w"), SMALL)
    by = {}
    for r in read_warc(spark, str(tmp_path / "w")).orderBy("file", "position").collect():
        by.setdefault(r["file"][:7], []).append(r["page_id"])
    assert len(by) > 3
    assert [i for k in sorted(by) for i in by[k]] == list(range(500))


def test_same_rows_same_archive(write, spark, tmp_path):
    """However the table is split, and with other shuffle partitions."""
    rows = pages()
    sums = []
    for k, parts in enumerate((1, 7)):
        m = write_warc(table(write, rows[::-1] if k else rows, parts), str(tmp_path / f"w{k}"), SMALL).collect()
        sums.append(sorted((r["name"], r["records"], r["sha256"]) for r in m))
    assert sums[0] == sums[1]


def test_heavy_range_is_dealt_out(write, spark, tmp_path):
    rows = [(5, f"http://{i}/", f"{i} " * 200) for i in range(300)] + [(10 ** 15, "u", "far " * 50)]
    m = write_warc(table(write, rows), str(tmp_path / "w"), SMALL).collect()
    assert len({r["shard"] for r in m}) > 5
    assert found(read_warc(spark, str(tmp_path / "w"))) == expected(rows)


def test_an_archive_is_not_written_over(write, spark, tmp_path):
    write_warc(table(write, [(1, "u", "x")]), str(tmp_path / "w"))
    with pytest.raises(ValueError, match="already"):
        write_warc(table(write, [(2, "u", "x")]), str(tmp_path / "w"))
    assert read_warc(spark, str(tmp_path / "w")).first()["page_id"] == 1


def test_empty_table(write, spark, tmp_path):
    assert write_warc(table(write, []), str(tmp_path / "w")).count() == 0
    assert read_warc(spark, str(tmp_path / "w")).count() == 0


def test_damage_is_found(write, spark, tmp_path):
    m = write_warc(table(write, pages()), str(tmp_path / "w"), SMALL).collect()
    f = tmp_path / "w" / m[0]["name"]
    data = f.read_bytes()
    f.write_bytes(data[:-40])
    with pytest.raises(Exception, match="ends within a record|differs from the manifest"):
        read_warc(spark, str(tmp_path / "w")).count()


def test_lost_attempts_leave_nothing(write, spark, tmp_path):
    """Files of an attempt that failed are not in the manifest, and go."""
    folder = tmp_path / "w"
    (folder / "_temporary").mkdir(parents=True)
    (folder / "_temporary" / "lost-0000000-0000-00000.warc.gz").write_bytes(b"half a file")
    rows = pages(50)
    write_warc(table(write, rows), str(folder), SMALL)
    assert found(read_warc(spark, str(folder))) == expected(rows) and not (folder / "_temporary").exists()


def test_long_page_is_read_in_pieces(write, spark, tmp_path):
    rows = [(1, "u", "word " * 2_000_000), (2, "v", "x")]
    write_warc(table(write, rows), str(tmp_path / "w"))
    assert found(read_warc(spark, str(tmp_path / "w"))) == expected(rows)


def test_query(spark):
    d = "/root/testdata/sf0.01"
    got = QUERIES["op13_warc"](spark, d)
    assert [f"{n} {t}" for n, t in got.dtypes] == ["page_id bigint", "payload_bytes bigint", "payload_digest string", "record_type string", "refers_to bigint"]
    rows = [(r["page_id"], None, r["html"]) for r in spark.read.parquet(f"{d}/pages.parquet").collect()]
    assert Counter(map(tuple, got.collect())) == Counter({(k[0], *k[2:6]): v for k, v in expected(rows).items()})
