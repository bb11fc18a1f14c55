"""Wall time of the registered queries; prints one JSON line.

BENCH_SF_DIR   folder of the tables      (default /root/testdata/sf0.1)
BENCH_CPUS     local cores               (default 8)
BENCH_RUNS     timed runs per query      (default 1, the median counts, after one warm-up run)
BENCH_QUERIES  comma-separated names     (default: all)

Each run builds the query anew and consumes every row with a sink that stores nothing.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

from trilayer.session import local_session
from workload.catalog import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))


def run(spark, build) -> float:
    start = time.perf_counter()
    build(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = local_session(
        "bench", CPUS, **{"spark.driver.memory": "8g", "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")}
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, QUERIES[name])
        seconds[name] = round(statistics.median(run(spark, QUERIES[name]) for _ in range(RUNS)), 3)
        print(name, seconds[name], file=sys.stderr)
    scale = re.search(r"sf([\d.]+)$", SF_DIR.rstrip("/"))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total median wall time of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else SF_DIR,
            }
        )
    )


if __name__ == "__main__":
    main()
