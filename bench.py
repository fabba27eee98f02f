"""Benchmark: stage, build, check and query the warehouse at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf", ...}.
Every step forces full computation with the ``noop`` sink (no collect to the
driver); the staging and warehouse steps write Parquet once, as a run does.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.registry import QUERIES, load_all  # noqa: E402
from basketry.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

# Headline steps, in run-book order: staging, warehouse build, DQ, verification, KPIs.
HEADLINE = [
    ("dq_report", "dq_report"),
    ("verify_report", "verify_report"),
    ("bq_s02_month", "bq_s02_month"),
    ("bq_s04_store", "bq_s04"),
    ("bq_s03_products_topk", "bq_s03_products"),
    ("kpi_month_over_month", "kpi_month_over_month"),
    ("support_status", "support_status"),
    ("bq_m03_avg_weekly", "bq_m03"),
    ("kpi_observed_difference", "kpi_observed_difference"),
    ("kpi_campaign", "kpi_campaign"),
    ("mart_sales_overview", "mart_sales_overview"),
    ("mart_price_analysis", "mart_price_analysis"),
    ("scope_summary", "scope_summary"),
    ("non_fanout_left_join", "non_fanout_left_join"),
    ("rerun_is_noop", "rerun_is_noop"),
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="basketry-bench-")
    spark = build_session(f"local[{CPUS}]", max(CPUS, 8), app="basketry-bench",
                          extra={"spark.checkpoint.dir": os.environ.get("BENCH_CHECKPOINT_DIR", scratch)})
    load_all()
    from basketry.plans.warehouse import warehouse
    times: dict[str, float] = {}
    t_all = time.time()

    # staging: the eight source tables written once
    t0 = time.time()
    wh = warehouse(spark, SF_DIR)
    src = wh.src
    for name in ["transactions_raw", "transactions", "promotions", "products", "demographics", "campaigns",
                 "campaign_descriptions", "coupons", "coupon_redemptions_raw", "coupon_redemptions"]:
        src.source(name)
    times["stage_sources"] = time.time() - t0

    # warehouse build: scope, calendar, dimensions (keys), bridges, facts
    t0 = time.time()
    for name in ["product_scope", "dim_date", "dim_product", "dim_household", "dim_store", "dim_campaign",
                 "dim_coupon", "bridge_campaign_household", "bridge_coupon_product", "fact_sales",
                 "promotion_grouped", "fact_promotion_weekly", "fact_coupon_redemption"]:
        getattr(wh, name)
    times["build_warehouse"] = time.time() - t0

    for label, key in HEADLINE:
        t0 = time.time()
        run(QUERIES[key](spark, SF_DIR))
        times[label] = time.time() - t0

    total = time.time() - t_all
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "warehouse_run_total", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(sf.group(1)) if sf else SF_DIR, "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
