"""Every query scans the fact table once and shuffles only partial aggregates
(checked from Spark's event log by tools/plan_report.py, in its own process)."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

from table_dirs import SF01

ROOT = Path(__file__).resolve().parent.parent


def test_one_scan_and_small_shuffles_per_query():
    run = subprocess.run([sys.executable, "tools/plan_report.py", SF01], cwd=ROOT,
                         capture_output=True, text=True, timeout=1200)
    assert run.returncode == 0, run.stderr[-2000:]
    table = [line for line in run.stdout.splitlines() if line.startswith("| ")]
    header = [c.strip() for c in table[0].strip("|").split("|")]
    rows = [dict(zip(header, (c.strip() for c in line.strip("|").split("|")))) for line in table[1:]]
    assert len(rows) == 41
    for r in rows:
        assert r["python"] == "False", r["query"]
        if r["query"] == "aircraft_dim":
            continue
        assert r["lineitem scans"] == "1", r["query"]
        read, shuffled = int(r["input records"]), int(r["shuffle records"])
        assert read >= 60000, r["query"]
        # partial aggregates only: a few groups per task, never the rows themselves
        assert shuffled <= 0.05 * read, (r["query"], shuffled, read)
