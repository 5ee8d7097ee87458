import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from roadflux import session

def imported(batches):
    import roadflux.functions.rules
    yield from batches

spark = session.tune(SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate())
assert spark.range(3).mapInArrow(imported, "id long").count() == 3
print("worked")
"""


def test_workers_of_a_foreign_session_have_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(repo=str(Path(__file__).resolve().parent.parent))
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "worked" in done.stdout, done.stderr[-2000:]
