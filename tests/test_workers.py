"""The Python workers must not need this package on their path."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__ as driver
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", driver.queries()["q24_leaf_columns"](spark, "/root/testdata/sf0.001").count())
"""


def test_tree_walk_from_another_folder(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, repo], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300
    )
    assert "rows 511" in done.stdout, done.stderr[-2000:]
