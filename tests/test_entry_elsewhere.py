"""The driver imports __spark_entry__ from another folder: Python workers must
not need this package on their path (the key-derivation UDF ships by value)."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as E
print("ROWS", E.queries()["decrypt_mixed_versions"](spark, "/root/testdata/sf0.001").count())
print("ENTRY", E.entry(spark).count())
"""


def test_queries_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 300" in out.stdout, out.stderr[-2000:]
    assert "ENTRY" in out.stdout
