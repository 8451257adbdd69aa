"""Executors need numpy and pyarrow, but no copy of this package."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pricefold.operators.adjustment import adjusted_days
from pricefold.session import local_session
spark = local_session(cores=2, shuffle_partitions=2, memory="1g")
rows = spark.sql("select 'a' as symbol, date'2020-01-01' as date, 5l as open, 5l as high, 5l as low, 5l as close, "
                 "0l as dividend, 0l as split_ratio")
print("adjusted", adjusted_days(rows).first()["adjusted_open"])
"""


def test_the_fold_runs_where_the_package_is_not_installed(tmp_path):
    environment = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, root], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300
    )
    assert "adjusted 5" in done.stdout, done.stderr[-2000:]
