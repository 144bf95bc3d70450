"""Skew guard: with one key holding a third of the rows, no task of our
operators reads that many shuffle records (a plain join on the hot group
does). Runs tools/skew_check.py in its own Spark process with an event log
in a scratch folder."""

import json
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_hot_key_is_never_read_by_one_task():
    scratch = tempfile.mkdtemp(prefix="cohortlake-skew-")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "skew_check.py"), scratch, "300000"],
                         capture_output=True, text=True, timeout=900, cwd=ROOT)
    assert out.returncode == 0, out.stderr[-2000:]
    res = json.loads(out.stdout.strip().splitlines()[-1])
    hot = res["hot_key_rows"]
    worst = res["max_shuffle_records_read_by_one_task"]
    contrast = worst.pop("plain_join_on_hot_group (contrast)")
    assert contrast >= hot
    assert worst and all(v < hot for v in worst.values()), worst
