"""Time the registered queries and print one JSON line.

Each query is planned and run to the end (every column computed, nothing kept) once to warm up and then
``BENCH_REPEATS`` times; the median counts. ``value`` is the sum over all queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from goldpan.plans.registry import queries  # noqa: E402
from goldpan.session import local_session  # noqa: E402


def run_once(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    wanted = sys.argv[1:]
    spark = local_session("goldpan-bench", cores, partitions=8)
    seconds = {}
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        run_once(query, spark, folder)
        seconds[name] = round(statistics.median(run_once(query, spark, folder) for _ in range(repeats)), 4)
    result = {
        "metric": "all_queries_warm_median",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
        "cores": cores,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
