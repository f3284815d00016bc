"""The driver contract works from a foreign working directory with a bare
session: streams, and functions that run in Python workers, must not need the
package there."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r'''
import importlib.util, sys
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry", sys.argv[1])
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2")
         .config("spark.ui.enabled", "false").getOrCreate())
print("entry_rows", len(entry.entry(spark).collect()))
print("import_rows", sorted(tuple(r) for r in entry.queries()["import_limits"](spark, "/root/testdata/sf0.001").collect()))
rows = entry.queries()["delayed_by_origin_stream"](spark, "/root/testdata/sf0.001").collect()
print("stream_rows", len(rows))
'''


def test_entry_from_foreign_cwd():
    cwd = tempfile.mkdtemp(prefix="aerostream-foreign-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, os.path.join(ROOT, "__spark_entry__.py")], cwd=cwd,
                         env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "entry_rows " in out.stdout
    assert "import_rows [('in time', 1000, False), ('too slow', 0, True)]" in out.stdout  # the slow read stalls in a Python worker
    n = int(out.stdout.split("stream_rows ")[1].split()[0])
    assert n > 0
