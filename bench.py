"""Time the headline queries: one warm-up, then the median of three runs, one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemill.plans.queries import QUERIES  # noqa: E402
from tidemill.session import build_session  # noqa: E402

HEADLINES = [
    "job_base_log", "job_base_db", "job_unique_visit", "job_user_jump", "job_order_wide",
    "job_payment_wide", "job_visitor_stats", "job_product_stats", "job_province_stats",
    "job_keyword_stats", "province_stats", "product_stats", "cdc_current_state",
    "repair_is_new", "user_jump", "unique_visit", "ijoin_order_detail", "split_words",
    "dim_sku", "stream_unique_visit", "stream_user_jump", "stream_repair_is_new",
    "stream_product_stats", "stream_ijoin",
]
STREAM_RUNS = 1


def run(spark, name: str, folder: str) -> float:
    """Seconds to compute every row and column of the query."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(master=f"local[{cpus}]", app="bench", shuffle_partitions=int(cpus))
    seconds = {}
    for name in only or HEADLINES:
        run(spark, name, folder)
        runs = STREAM_RUNS if name.startswith("stream_") else 3
        seconds[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "shuffle_partitions": int(cpus)}))


if __name__ == "__main__":
    main()
