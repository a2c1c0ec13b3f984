"""Jobs return the same rows when tasks fail and are retried (own Spark process)."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_results_survive_task_retries():
    proc = subprocess.run([sys.executable, os.path.join(ROOT, "scripts", "fault_probe.py"),
                           "/root/testdata/sf0.001"],
                          capture_output=True, text=True, timeout=600, cwd=ROOT)
    assert proc.returncode == 0, proc.stderr[-2000:]
    out = json.loads(proc.stdout.strip().splitlines()[-1])
    assert out["all_equal"], out
    assert all(n > 0 for n in out["failed_task_attempts"].values()), out
