"""The entry module imports anywhere: no session, PySpark from its zips."""

import glob
import os
import subprocess
import sys

import pyspark

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_a_jvm():
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = [os.path.join(lib, "pyspark.zip"), *glob.glob(os.path.join(lib, "py4j-*.zip"))]
    code = ("import __spark_entry__ as e; from pyspark import SparkContext; q, o = e.queries(), e.oracle_sql();"
            "assert len(q) >= 48 and set(o) <= set(q) and SparkContext._active_spark_context is None; print('ok')")
    env = os.environ | {"PYTHONPATH": ":".join([ROOT, *zips])}
    out = subprocess.run([sys.executable, "-c", code], cwd="/", env=env, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip().endswith("ok"), out.stderr[-2000:]
