"""Operators whose tasks use classes of this package run where executors have no copy of it."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
SCRIPT = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from harness.compare import local_session
from watchpost.llm.queries import QUERIES
spark = local_session("4")
for name in ("op3_decontaminate", "op11_recurrent_scores", "op12_token_alignment", "op13_centroid_clustering"):
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_executors_need_no_copy(tmp_path):
    (tmp_path / "run.py").write_text(SCRIPT)
    plain = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "run.py"], cwd=tmp_path, env=plain, capture_output=True, text=True, timeout=280)
    assert ran.returncode == 0, ran.stderr[-2000:]
    rows = dict(line.split() for line in ran.stdout.splitlines() if line.startswith("op"))
    assert rows == {"op3_decontaminate": "200", "op11_recurrent_scores": "200", "op12_token_alignment": "200",
                    "op13_centroid_clustering": "500"}
