"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_bench_prints_one_json_line(tmp_dir):
    env = {**os.environ, "BENCH_SF_DIR": SF, "BENCH_CPUS": "2", "BENCH_QUERIES": "top_earners,quality_report"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], cwd=tmp_dir, env=env,
                         capture_output=True, text=True, timeout=900)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert out.returncode == 0 and len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and rec["metric"]
    assert set(rec["queries"]) == {"build", "top_earners", "quality_report"}
    assert rec["value"] == pytest.approx(sum(rec["queries"].values()), abs=0.01)
