"""bench.py prints exactly one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_RUNS="1", BENCH_CPUS="2", BENCH_QUERIES="head_preview,first_int")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and set(rec["queries"]) == {"head_preview", "first_int"}
    assert rec["value"] == pytest.approx(sum(rec["queries"].values()), abs=1e-3)
