"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default sf0.1) names the data, ``BENCH_CPUS`` (default 8) the
local cores, ``BENCH_QUERIES`` a comma-separated choice ("all" for every query).
Each query runs once after a warm-up and is consumed by the no-op sink, so all
columns of all rows are computed.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.plans import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "revenue_daily",
    "customer_metrics",
    "product_performance",
    "customer_rfm_90d",
    "product_trend_7d",
    "revenue_date_cat_region",
    "revenue_enriched",
    "top_customers",
    "fct_orders",
    "fct_returns",
    "dq_rules",
    "duplicate_keys",
    "dedup_orders",
    "latest_per_key",
    "scd1_upsert",
    "scd2_apply",
    "apply_changes_scd2",
    "point_in_time_join",
    "pit_leakage_audit",
    "broadcast_two_dims",
    "change_feed",
    "incremental_revenue",
    "partitioned_write",
    "compact_files",
    "zorder_layout",
    "orders_stream",
    "stream_daily_revenue",
    "stream_dedup",
    "stream_upsert_revenue",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    # warm-up: class loading, code generation, and the stored layers that later queries read
    layers = run(spark, "revenue_daily", sf_dir)

    seconds = {name: run(spark, name, sf_dir) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "layers_and_warm_up": layers,
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


if __name__ == "__main__":
    main()
