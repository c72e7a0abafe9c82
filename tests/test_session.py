"""The package reaches Python workers that are started where it is not installed."""

from __future__ import annotations

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as contract
from tidemill.session import local_session
spark = local_session(2, 2)
print("rows", contract.queries()["bm25_search"](spark, {folder!r}).count())
"""


def test_queries_run_from_another_folder(tmp_path, small):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, folder=small)], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=300, check=False)
    assert run.returncode == 0 and "rows" in run.stdout, run.stderr[-2000:]
