"""bench.py prints one JSON line in the driver's format."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g")
    proc = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "hourly_utilization"],
                          capture_output=True, text=True, env=env, timeout=600, cwd=ROOT)
    lines = [line for line in proc.stdout.splitlines() if line.startswith("{")]
    assert proc.returncode == 0 and len(lines) == 1, proc.stderr[-2000:]
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001 and set(out["queries"]) == {"hourly_utilization"}
    assert out["value"] == out["queries"]["hourly_utilization"] and "failed" not in out
