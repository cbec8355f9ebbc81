"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS (timed runs after one
warm-up run, median taken).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillstone.queries import load_all  # noqa: E402
from tillstone.session import build_session  # noqa: E402

HEADLINE = (
    "daily_sales_summary",
    "silver_detailed_invoices",
    "silver_detailed_credit_notes",
    "silver_summarized_invoices",
    "potential_duplicate_flag",
    "dedup_keep_first",
    "duplicate_groups",
    "whitespace_profile",
    "null_percentages",
    "daily_invoices_detailed",
    "daily_log_stats",
    "manifest_upsert",
    "changed_files",
    "standardize_table",
)


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    queries, _ = load_all()
    spark = build_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            queries[name](spark, data_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": data_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
