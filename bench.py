"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), and optionally
BENCH_QUERIES, a comma-separated choice of names.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewell.session import build_session
from workload.registry import registered


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus,
        spark__checkpoint__dir=os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    all_queries = registered()
    names = chosen or list(all_queries)
    all_queries["segment_churn"][0](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        all_queries[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds over all queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
