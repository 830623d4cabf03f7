"""Python workers get the package from the driver: nothing of it is on their path."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_image_queries_run_from_a_foreign_folder(tmp_path):
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        import __spark_entry__ as E
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").getOrCreate())
        for name in ("image_bbox", "charset_filter"):
            print(name, E.queries()[name](spark, "/root/testdata/sf0.001").count())
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "image_bbox 200" in out.stdout and "charset_filter 200" in out.stdout
