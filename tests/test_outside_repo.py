"""The driver may import the contract from another directory with a plain
session: Python workers then cannot import ``backdrop`` from disk, so the
package must travel with the pickled functions."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "America/Los_Angeles").getOrCreate())
import __spark_entry__ as E
assert E.entry(spark).count() > 0
for name in ["composite_threshold", "capture_decode", "stream_frame_counter", "replay_png_folder"]:
    assert E.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("OUTSIDE-OK")
"""


def test_contract_runs_from_another_directory():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as cwd:
        res = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                             timeout=900)
    assert "OUTSIDE-OK" in res.stdout, res.stderr[-3000:]
