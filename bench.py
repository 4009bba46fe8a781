"""Benchmark: run the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_QUERIES (comma list, default the headline set).
Each query is built and executed into Spark's ``noop`` sink (every row is
produced, none is shipped to Python); the time covers planning, any
materialisation jobs and execution.  One warm-up query runs first so JVM
start-up is not charged to the first query; each query then runs
BENCH_RUNS times (default 2) and the best time is reported, the first
(cold: planning + code generation) separately.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratum.plans import catalog, fixtures  # noqa: E402
from stratum.session import build_session  # noqa: E402

HEADLINE = [
    # the reference's six analyses (+ the grouping-sets form)
    "age_effect", "grit_by_tier", "industry_dominance", "rank_correlation",
    "value_by_tier", "factor_dominance", "factor_grouping_sets",
    # pipeline stages
    "silver_startups", "silver_executive_profiles", "gold_dim_company",
    "gold_dim_executive", "gold_fact",
    # operators with their own scale concerns
    "dense_keys", "name_key", "best_per_key", "explode_founders",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", app="stratum-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    # warm-up (JVM, codegen caches); not timed
    catalog.QUERIES["slug_id"](spark, sf_dir).collect()
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times, cold = {}, {}
    # the stored inputs that the analyses and the gold queries read: once per session, timed on their own
    for name, build in (("store_star", fixtures.star), ("store_gold_inputs", catalog._gold_inputs),
                        ("store_gold_dims", catalog._gold_dims)):
        t0 = time.perf_counter()
        build(spark, sf_dir)
        cold[name] = times[name] = round(time.perf_counter() - t0, 3)
    for name in names:
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            # the noop sink runs the whole plan without shipping rows to Python
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(round(time.perf_counter() - t0, 3))
        cold[name] = samples[0]
        times[name] = min(samples)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "stat": f"best of {runs} runs per query (first run also in cold_queries)",
        "cold_queries": cold,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
