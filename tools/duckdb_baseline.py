"""Time the oracle SQL (the source reports' literal SQL shape) on DuckDB, one process.

usage: python tools/duckdb_baseline.py [sf_dir] [threads]
Prints one JSON line like bench.py, as a single-node reference point.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from spendlens.catalog.oracle import ORACLE_SQL  # noqa: E402
from oracle_check import TABLES  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    times = {}
    for name, sql in ORACLE_SQL.items():
        best = None
        for _ in range(3):
            t0 = time.perf_counter()
            con.execute(f"SELECT count(*) FROM ({sql})").fetchall()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    print(json.dumps({"metric": "duckdb_oracle_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "threads": threads, "sf_dir": sf_dir}))


if __name__ == "__main__":
    main()
