"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is built and then fully executed into Spark's no-op sink (all
rows computed, nothing collected to the driver).  Queries that write a lake
include their writes (into a fresh folder on every run).  Each query runs
$BENCH_REPEATS times (default 2): ``runs`` has all times, ``queries`` the best
one, which damps the noise of a shared machine; ``value`` is the sum over all
queries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattlake.plans import registry  # noqa: E402
from wattlake.session import build_session  # noqa: E402

def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = set(sys.argv[1:])
    spark = build_session(
        app="wattlake-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus * 2,
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Warm up the JVM and the file listing cache outside the timings.
    registry.QUERIES["daily_consumption"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    timings, runs = {}, {}
    for _ in range(repeats):
        for name, fn in registry.queries().items():
            if only and name not in only:
                continue
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = round(time.perf_counter() - t0, 3)
            runs.setdefault(name, []).append(took)
            timings[name] = min(runs[name])
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "runs": runs,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
