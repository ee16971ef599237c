"""The entry module works when loaded by path from another directory, with
Python workers that never saw the repository (keyed-state query included)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spec = importlib.util.spec_from_file_location("entry", {os.path.join(REPO, '__spark_entry__.py')!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
print("ENTRY", entry.entry(spark).count())
print("STATE", entry.queries()["stream_path_distance"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_entry_and_keyed_state_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="tramline-elsewhere-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = dict(ln.split() for ln in out.stdout.splitlines() if ln.startswith(("ENTRY", "STATE")))
    assert int(lines["ENTRY"]) >= 0 and int(lines["STATE"]) > 0
