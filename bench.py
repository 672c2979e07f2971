"""Times the registered queries and prints one JSON line.

Each query is built and run to the end into a sink that drops the rows. The
first run warms up; the value kept is the median of the timed runs. Queries
that run whole jobs write and load tables many times and are run once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from stratakeep.plans.job_queries import JOB_QUERIES
from stratakeep.plans.queries import QUERIES
from stratakeep.session import local_session

HEADLINE = [*(name for name in QUERIES if name not in JOB_QUERIES), *JOB_QUERIES]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, memory=os.environ.get("BENCH_MEMORY", "8g"), app="stratakeep-bench")
    times = {}
    for name in names:
        if name in JOB_QUERIES:
            times[name] = round(run(spark, name, sf_dir), 3)
            continue
        run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(repeats)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
