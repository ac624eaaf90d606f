"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder of the source tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up (default 1); the median counts
BENCH_ONLY    comma-separated query names (default: the list below)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from lakemart.plans.medallion import lake
from lakemart.plans.queries import QUERIES
from lakemart.session import local_session

HEADLINE = (
    "q_clean_customers", "q_dedupe_latest", "q_scd2_seconds", "q_scd2_micros", "q_ri_semi", "q_ri_reject",
    "q_surrogate_keys", "q_dim_date", "q_fact_transactions", "q_fact_loan_payments", "q_payment_schedule",
    "q_branch_daily", "q_customer_daily_wide", "q_key_coverage", "q_rank_running",
    "m_txn", "m_loan", "m_pay", "m_overlap", "m_branch", "m_exec", "m_segment", "m_share", "m_deposit", "m_portfolio",
    "m_time_month", "m_time_day", "m_pareto",
)


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus), app="lakemart-bench")
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    lake(spark, folder).build()
    seconds = {"lake_build": round(time.perf_counter() - start, 3)}
    for name in names:
        run(QUERIES[name], spark, folder)
        seconds[name] = round(statistics.median(run(QUERIES[name], spark, folder) for _ in range(runs)), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline queries, lake build included", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
