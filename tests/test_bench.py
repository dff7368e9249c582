"""bench.py contract: one JSON line with the per-query times."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "word_count", "global_count"],
        capture_output=True, text=True, env=env, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"word_count", "global_count"} and "failed" not in result
    assert result["value"] == round(sum(result["queries"].values()), 3)
