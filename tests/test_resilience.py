"""Layer writes survive failed task attempts (subprocess with task retries)."""

import json
import os
import subprocess
import sys


def test_writes_are_exact_after_task_failures():
    here = os.path.dirname(os.path.abspath(__file__))
    proc = subprocess.run([sys.executable, os.path.join(here, "resilience_job.py")],
                          capture_output=True, text=True, timeout=600,
                          cwd=os.path.dirname(here))
    lines = [l for l in proc.stdout.splitlines() if l.startswith("RESULT ")]
    assert lines, proc.stderr[-3000:]
    out = json.loads(lines[-1][len("RESULT "):])
    assert out["rows"] == 600 and out["distinct_events"] == 600
    assert out["silver"] == out["expected_silver"]
