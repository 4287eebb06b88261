import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from evalspark import session
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[2]).getOrCreate())
assert session.shared_dir(spark) == sys.argv[2]
df = session.materialise(spark.range(3), "t")
assert df.count() == 3
print(df.inputFiles()[0])
"""


def test_intermediate_tables_go_to_the_named_folder(tmp_path):
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT, ROOT, str(tmp_path)],
        capture_output=True,
        text=True,
        timeout=120,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert str(tmp_path) in out.stdout.strip().splitlines()[-1]


def test_settings(spark):
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
