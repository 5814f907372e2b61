"""Jobs run from a folder without the package: what is sent to workers needs no copy of it there."""
import os
import subprocess
import sys


REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
#: The driver finds the package by sys.path alone, which workers do not inherit.
RUN = """
import sys
sys.path.insert(0, {repo!r})
from ledgerpulse.session import build_session
from ledgerpulse.llm.queries import QUERIES
spark = build_session("workers", "local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"}})
spark.sparkContext.setLogLevel("ERROR")
for name in {names!r}:
    assert QUERIES[name](spark, {sf!r}).count() > 0, name
spark.stop()
"""


def test_every_query_runs_from_an_empty_folder(tmp_path):
    from ledgerpulse.llm.queries import QUERIES

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = RUN.format(repo=REPO, names=sorted(QUERIES), sf=SF)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
