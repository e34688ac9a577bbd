"""Hot-key guard: per-key sequence jobs must spread a key holding a third of all rows.

Runs tools/skew_report.py in its own Spark process (it needs the event log
from session start) and reads the largest number of shuffle records one task
read in each run.
"""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_hot_key_is_spread_over_tasks():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "skew_report.py"),
                          "/root/testdata/sf0.01", "6"],
                         capture_output=True, text=True, timeout=600, cwd=ROOT)
    runs = {}
    for line in out.stdout.splitlines():
        if line.startswith("{"):
            r = json.loads(line)
            runs[r["run"].split(" ")[0]] = r
    assert set(runs) == {"failure_streak", "ttl_exclude", "failure_streak_burst", "ttl_exclude_burst",
                         "trailing_topn_avg", "plain"}, out.stderr[-2000:]
    hot = runs["plain"]["hot_user_rows"]
    assert hot * 3 == runs["plain"]["rows"]
    # the plain per-key window puts the whole hot key into one task ...
    assert runs["plain"]["max_records_per_task"] >= hot
    # ... chunks of bounded row counts do not, also when the hot key's rows fall
    # within two hours, a third of them at one instant and some without a time
    for name in ("failure_streak", "ttl_exclude", "failure_streak_burst", "ttl_exclude_burst"):
        assert runs[name]["max_records_per_task"] < hot / 2, runs[name]
    # top-n per key ships at most n rows per key and task before its shuffle
    assert runs["trailing_topn_avg"]["max_records_per_task"] < hot / 20
