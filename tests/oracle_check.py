"""Run every named query in Spark and its SQL in DuckDB; compare the results.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``.  The comparison
is order-insensitive on rows and requires identical column names and types,
row counts and values (floats compared exactly, as the driver's value hash does).
"""

from __future__ import annotations

import math
import sys
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as E  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "item"):
        v = v.item()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


SPARK_TO_DUCK = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN"}


def compare(spark, con, name: str, sf_dir: str, fn=None) -> tuple[bool, str]:
    sdf = (fn or E.queries()[name])(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(E.oracle_sql()[name])
    d_cols = rel.columns
    d_types = dict(zip(d_cols, map(str, rel.types)))
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duckdb={d_cols}"
    if s_types != d_types:
        return False, f"types differ: spark={s_types} duckdb={d_types}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duckdb={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(s_rows)} rows"


def main(argv):
    from ontime_analytics.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or [n for n in E.queries() if n in E.oracle_sql()]
    spark = get_session(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        ok, msg = compare(spark, con, n, sf_dir)
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {n}: {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
