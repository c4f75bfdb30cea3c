"""Benchmark: stage build + headline queries over the driver tables.

Prints one JSON line. ``value`` is the end-to-end wall time: building every
stage table (raw landing, quality flags, dimensions, curated table, both
marts) from the raw tables plus running the headline queries. Each query is
executed with the ``noop`` sink, so the time is Spark's, not the driver's
collection. Before timing, the same code runs once over the smallest driver
tables (sf0.001) to load classes and compile generated code; that warm-up is
reported separately (``warmup_sec``) and not included in ``value``.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "monthly_summary", "daily_summary", "top_category_per_borough_month", "category_totals_ytd",
    "monthly_volume", "top_complaint_types", "resolution_by_category", "daily_trend",
    "borough_category_pivot", "rejection_reason_counts", "ingestion_report", "threshold_checks",
    "dim_build_report", "quality_profile", "reconcile_monthly", "valid_requests",
    "rejected_requests", "flag_duplicate_keys", "keyset_page", "incremental_slice",
    "csv_roundtrip", "partitioned_roundtrip", "external_table_scan", "fractional_hours_summary",
    # write-heavy round trips, landings and the catalog path
    "csv_two_headers", "json_pages_scan", "stream_landing", "capped_slice", "slice_manifest",
    "mirror_reconcile", "mirror_reconcile_damaged", "split_sink", "serving_load", "dedup_raw_requests",
    "sql_tables", "sql_monthly_summary", "sql_daily_summary", "sql_top_category_per_borough_month",
    "sql_reconcile_monthly", "sql_monthly_volume", "sql_top_complaint_types", "sql_category_totals_ytd",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from ticketflow.session import local_session
    from ticketflow.plans import flow
    from ticketflow.plans.registry import QUERIES

    spark = local_session(cpus, app="ticketflow-bench", extra={
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    })
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    tw = time.time()
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf):
        flow.testdata_stages(spark, warm_dir).build()
        for name in HEADLINE:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    warmup = round(time.time() - tw, 3)

    t0 = time.time()
    stages = flow.testdata_stages(spark, sf).build()
    build = time.time() - t0

    times: dict[str, float] = {"stage_build": round(build, 3)}
    for name in HEADLINE:
        t = time.time()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    total = round(time.time() - t0, 3)
    print(json.dumps({"metric": "pipeline_and_queries_wall", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
                      "cpus": cpus, "stage_rows": stages.counts, "warmup_sec": warmup,
                      "warmup_sf": os.path.basename(warm_dir.rstrip("/")).replace("sf", "")}))
    spark.stop()


if __name__ == "__main__":
    main()
