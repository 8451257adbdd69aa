"""Time the queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs twice and the faster run counts, so that code generation of the first run is left out. Results are
computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pricefold.session import local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

RUNS = 2


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 8)
    spark = local_session(cores=cores, shuffle_partitions=cores)
    times = {
        name: round(min(seconds(lambda: query(spark, sf_dir)) for _ in range(RUNS)), 3)
        for name, query in QUERIES.items()
    }
    spark.stop()
    result = {"metric": "total query time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times}
    print(json.dumps(result | {"sf": float(Path(sf_dir).name.removeprefix("sf"))}))


if __name__ == "__main__":
    main()
