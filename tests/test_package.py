"""The package works where Python workers cannot import it."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
print("rows", entry.queries()["feature_value_text"](spark, "/root/testdata/sf0.001").where("plain IS NOT NULL").count())
"""


def test_from_another_folder(tmp_path):
    root = str(Path(__file__).parent.parent)
    done = subprocess.run([sys.executable, "-c", SCRIPT, root], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 6" in done.stdout, done.stderr[-2000:]
