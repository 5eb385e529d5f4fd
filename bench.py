"""Time every query once on one machine and print one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from orelake.session import local_session
from orelake.workload import QUERIES, views


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, work: Callable[[], object]) -> None:
        started = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)

    # Start-up is not part of any query.
    views.table(spark, folder, "nation").count()
    # The silver tables are written once and read by the later queries.
    timed("build_silver_modules", lambda: views.silver_modules(spark, folder))
    timed("build_silver_issues", lambda: views.silver_issues(spark, folder))
    timed("build_dimension", lambda: views.dimension(spark, folder))
    for name in names:
        timed(name, lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())

    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
