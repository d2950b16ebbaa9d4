"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR   test tables, default /root/testdata/sf0.1
BENCH_CPUS     local cores, default 8
"""

from __future__ import annotations

import json
import os
import time

from orderflow.plans.named_queries import QUERIES
from orderflow.session import local_session

HEADLINE = (
    "net_changes_since",
    "capture_orders",
    "capture_all_orders",
    "stage_preagg",
    "merge_orders_reference",
    "merge_orders",
    "order_summary",
    "load_run",
    "load_stream",
    "column_domains",
    "assign_order_keys",
    "split_order_details",
)


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    seconds(spark, "capture_orders", sf_dir)  # start-up and class loading
    timed = {name: seconds(spark, name, sf_dir) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
