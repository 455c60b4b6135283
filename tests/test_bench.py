"""bench.py prints one JSON line with the agreed fields (run in its own process)."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF001


def test_bench_contract(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_REPEATS="1",
               BENCH_WARMUP_DIR=str(tmp_path / "none"), BENCH_CPUS="2", BENCH_CORPUS="0")
    proc = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                          capture_output=True, text=True, timeout=900, cwd=str(tmp_path))
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [ln for ln in proc.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["metric"] == "total_sec" and out["unit"] == "sec" and out["sf"] == 0.001
    assert out["value"] > 0 and "job_total" in out["queries"] and "report_lines" in out["queries"]
