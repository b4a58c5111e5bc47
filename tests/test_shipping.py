"""The package reaches the workers of a session that was started somewhere else."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
SCRIPT = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.sql.session.timeZone", "UTC").getOrCreate())
import __spark_entry__
for name in ("r1_elo_ladders", "e4_score_pairs"):
    print(name, __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count() > 0)
"""


def test_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "r1_elo_ladders True" in done.stdout and "e4_score_pairs True" in done.stdout, done.stderr[-2000:]
