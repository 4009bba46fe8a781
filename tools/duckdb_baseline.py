"""Time the oracle SQL of the bench queries in DuckDB on the same parquet files.

DuckDB is the reference's engine; this gives a single-node number for the
same work at the same scale.  Prints one JSON line like bench.py.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import bench  # noqa: E402
from stratum.plans.catalog import ORACLE  # noqa: E402
from stratum.sources.tables import TABLES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    threads = int(os.environ.get("BENCH_CPUS", "8"))
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    times = {}
    for name in bench.HEADLINE:
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            con.execute(ORACLE[name]).fetchall()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    print(json.dumps({"metric": "duckdb_oracle_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "threads": threads, "sf_dir": sf_dir}))


if __name__ == "__main__":
    main()
