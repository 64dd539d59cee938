"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_QUERIES="pivot_wide,group_sum",
               BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True,
                         timeout=600, env=env, cwd=ROOT)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"pivot_wide", "group_sum"}
    assert d["value"] == round(sum(d["queries"].values()), 3) and isinstance(d["metric"], str)
