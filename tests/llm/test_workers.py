"""Queries that run Python must not need this package on the workers."""

import os
import subprocess
import sys

from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
NAMES = ("op1_simhash", "op3_quality", "op4_fingerprints", "op5_quality_rules", "op6_toxicity", "op7_pii", "op10_sentencepiece",
         "op11_secret_scan", "op12_centroid_clustering", "op13_alignment", "pipeline", "path_attribution")
SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
def importable(_):
    try:
        import hearth
        return True
    except ModuleNotFoundError:
        return False
assert not any(spark.sparkContext.parallelize(range(4), 4).map(importable).collect()), "the workers can import the package"
sys.path.insert(0, sys.argv[1])
import __spark_entry__
for name in sys.argv[3:]:
    print(name, __spark_entry__.queries()[name](spark, sys.argv[2]).count(), flush=True)
"""


def test_python_queries_without_the_package_on_workers(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, SF_SMALL, *NAMES], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1500)
    assert got.returncode == 0, got.stderr[-2000:]
    assert [line.split()[0] for line in got.stdout.splitlines()] == list(NAMES)
