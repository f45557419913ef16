"""Python tasks run where the package is not importable by the workers."""

import os
import subprocess
import sys

SCRIPT = """
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("entry", {path!r})
module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(module)
for name in ("htm04_officers", "udf01_run_items"):
    assert module.queries()[name](spark, {sf!r}).count() > 0
print("shipped")
"""


def test_workers_need_no_package(sf, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = SCRIPT.format(path=os.path.join(root, "__spark_entry__.py"), sf=sf)
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("shipped"), out.stderr[-2000:]
