"""Tasks must not depend on this package being importable where they run."""

from __future__ import annotations

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from recspark import build_session
spark = build_session("elsewhere", "local[2]", **{"spark.sql.shuffle.partitions": 2, "spark.ui.enabled": "false"})
print("ROWS", entry.entry(spark).count(), entry.queries()["item_topk_blocks"](spark, sys.argv[2]).count())
"""


def test_tasks_run_in_a_foreign_folder(tmp_path, sf_dir):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, repo, sf_dir], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "ROWS 1500 5000" in done.stdout, done.stderr[-2000:]
