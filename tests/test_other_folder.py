"""The package works when only the driver can import it: workers get it from Spark."""

import os
import subprocess
import sys

from tests.conftest import SF_SMALL

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as E
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", E.queries()["vector_topk"](spark, {data!r}).count())
"""


def test_workers_get_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, data=SF_SMALL)], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=240)
    assert "ROWS 30" in out.stdout, out.stderr[-2000:]


MISSING = """
import sys
sys.path.insert(0, {repo!r})
sys.modules["zstandard"] = sys.modules["tokenizers"] = None  # as if these were not installed
import __spark_entry__ as E
names = E.queries()
print("QUERIES", len(names), "ORACLES", len(E.oracle_sql()), [n for n in names if n.startswith("op")])
"""


def test_other_queries_survive_a_missing_module(tmp_path):
    from fjord.plans.queries import QUERIES

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", MISSING.format(repo=repo)], cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert f"QUERIES {len(QUERIES)} ORACLES {len(QUERIES)} []" in out.stdout, out.stderr[-2000:]
