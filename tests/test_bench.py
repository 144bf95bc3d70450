"""bench.py prints one JSON line with the agreed keys (run on sf0.001)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4", BENCH_RUNS="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True,
                         timeout=1200, env=env, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    res = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(res)
    assert res["unit"] == "sec" and res["sf"] == "0.001" and len(res["queries"]) == 23
    assert abs(res["value"] - sum(res["queries"].values())) < 0.01
