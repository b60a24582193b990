"""A key holding a third of all rows never lands in one task (event-log measurement)."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(os.environ.get("NIMBUS_FAST") == "1", reason="starts a second Spark")
def test_hot_key_is_folded_before_the_shuffle():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "scripts", "skew_check.py"), "/root/testdata/sf0.001"],
                         capture_output=True, text=True, timeout=600, cwd=ROOT)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith('{"rows"')]
    assert line, out.stderr[-2000:]
    res = json.loads(line[-1])
    worst = res["max_shuffle_records_read_by_one_task"]
    assert set(worst) == {"dedupe", "latest_per_city", "hourly_avg", "pk_audit", "detect_changes"}
    # a third of the rows sit on one key; without map-side folding one task would read them all
    for op, recs in worst.items():
        assert recs < res["hot_key_rows"], (op, recs, res)
