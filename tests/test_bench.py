"""bench.py prints exactly one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="mask_columns,extract_table_split")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1, out.stderr[-2000:]
    doc = json.loads(lines[0])
    assert doc["unit"] == "sec" and doc["sf"] == 0.001 and doc["metric"]
    assert set(doc["queries"]) == {"mask_columns", "extract_table_split"}
    assert abs(doc["value"] - sum(doc["queries"].values())) < 0.01
