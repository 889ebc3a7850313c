"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and executed in full with the ``noop`` sink (every row is produced,
nothing is collected to the driver). Every query runs BENCH_REPEATS times (default 2):
``queries`` holds the best run per query (warm JVM and compiled code, as on a long-lived
cluster), ``cold_queries`` the first run. Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spendlens.catalog.queries import QUERIES  # noqa: E402
from spendlens.session import local_session  # noqa: E402

HEADLINE = ["report_platform", "report_campaign", "report_ad_group", "report_keyword",
            "report_multi_fact"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "2")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    warehouse = tempfile.mkdtemp(prefix="spendlens-bench-")
    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2),
                          warehouse=os.path.join(warehouse, "wh"))
    names = only or (HEADLINE + [q for q in QUERIES if q not in HEADLINE])

    # warm-up: JVM, Parquet readers and code generation (not timed)
    QUERIES["daily_rollup"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        cold[name] = round(runs[0], 3)
        timings[name] = round(min(runs), 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus,
                      "repeats": repeats,
                      "headline_seconds": round(sum(timings[q] for q in HEADLINE
                                                    if q in timings), 3),
                      "cold_value": round(sum(cold.values()), 3),
                      "cold_queries": cold}))


if __name__ == "__main__":
    main()
