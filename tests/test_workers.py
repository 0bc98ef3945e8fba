"""Python workers need no copy of the package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
from reelbook import configure, extract_profiles
configure(spark)
page = '<h2 data-e2e="user-subtitle">ann &amp; bob</h2>'
rows = [("profiles/ann/t.html", page)]
pages = spark.createDataFrame(rows, "path string, html string").selectExpr("*", "now() time_created")
print("found:", extract_profiles(pages).first().username)
"""


def test_markup_reader_travels_by_value(tmp_path):
    env = {key: value for key, value in os.environ.items() if key != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True,
        timeout=120,
    )
    assert "found: ann & bob" in done.stdout, done.stderr[-2000:]
