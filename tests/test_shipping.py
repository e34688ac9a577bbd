"""Jobs with Python workers run as the first query of a session that was started in another folder."""

import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL

CODE = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", {entry!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC").getOrCreate()
for name in ("failure_streak_health", "trailing_topn_series"):
    print(name, entry.queries()[name](spark, {sf!r}).count())
"""


def test_first_query_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = CODE.format(entry=os.path.join(ROOT, "__spark_entry__.py"), sf=SF_SMALL)
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    found = dict(line.split() for line in out.stdout.splitlines() if line.startswith(("failure", "trailing")))
    assert set(found) == {"failure_streak_health", "trailing_topn_series"}, out.stderr[-2000:]
    assert all(int(n) > 0 for n in found.values())
