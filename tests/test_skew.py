"""Skew guard: with one key (also null, also rows equal in all) holding a third of all rows, no single task may
read more than a quarter of any shuffle (tools/skew_check.py, own session)."""

import os
import re
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_hot_key_is_spread_over_tasks():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "skew_check.py"), "/root/testdata/sf0.01"],
                         capture_output=True, text=True, timeout=900, cwd=ROOT)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "hot key share of rows: 33" in out.stdout
    shares = dict(re.findall(r"^\| ([^|]+?) \| ([0-9.]+)% \|", out.stdout, re.M))
    assert len(shares) == 8, out.stdout
    for op, share in shares.items():
        assert float(share) < 25.0, (op, share, out.stdout)
