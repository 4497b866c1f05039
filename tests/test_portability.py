"""The registered queries run from any working directory with the repo only
on the driver's sys.path (as a harness importing __spark_entry__ does): the
Python workers must not need to import this package."""

import subprocess
import sys
import textwrap
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_queries_run_from_another_directory(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {str(ROOT)!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]")
                 .config("spark.ui.enabled", "false").getOrCreate())
        import __spark_entry__ as E
        print("ROWS", E.entry(spark).count(),
              E.queries()["auc_amount"](spark, "/root/testdata/sf0.001").count())
    """)
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 2 1" in out.stdout, out.stderr[-2000:]
