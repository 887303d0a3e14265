"""bench.py prints exactly one JSON line with the agreed fields."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "coauthor_weight", "slugify"],
                         capture_output=True, text=True, env=env, timeout=600, cwd="/tmp")
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert out.returncode == 0 and len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] == "catalogue_total" and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"coauthor_weight", "slugify"} and d["value"] > 0
