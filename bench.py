"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.  Every query is executed in full with the no-op sink
(nothing is collected to the driver)."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from churnlens.plans.catalog import REGISTRY, transactions  # noqa: E402
from churnlens.session import local_session  # noqa: E402

HEADLINE = [
    "client_month_panel",      # the reference's ETL aggregate (A1/A2 + MRR fill)
    "model_ready",             # + trailing windows, join, churn truncation
    "sla_hotspots",            # flagship: latest month + top-k
    "segment_churn_rate",
    "box_summary",
    "lorenz_curve",
    "gini_top_decile",
    "kde_mrr",
    "risk_ranking",
    "recommendations",
    "retention_impact",
    "what_if",
    "roc_auc",
    "pr_auc",
    "churn_adjusted_forecast",
    "hw_forecast",
    "hw_naive_forecast",
    "gbt_lag_forecast",
    "forecast_model_choice",
    "revenue_forecast",
    "billing_calendar",
    "csv_round_trip",
    "incremental_panel",
    "incremental_client_panel",
    "model_compare",           # three fits and their evaluation
    "driver_importance",
    "risk_ranking_ml",
    "what_if_ml",
]
WARM_LIMIT = 30.0  # a query is run a second time if its first run took less


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in sys.argv[1:] if q in REGISTRY] or HEADLINE
    spark = local_session(cpus=cpus)
    # warm-up on the smallest scale (other files, so nothing measured is reused):
    # JVM start and JIT, Python workers, ML classes
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in ("model_ready", "what_if", "hw_forecast"):
            REGISTRY[name].run(spark, warm_dir).write.format("noop").mode("overwrite").save()
    times, warm = {}, {}

    def timed(name: str) -> float:
        t0 = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3)

    # cold: the first query of a family also builds the products it reads; warm: these exist
    for name in only:
        times[name] = timed(name)
        if times[name] < WARM_LIMIT:
            warm[name] = timed(name)
    # throughput of the reference's ETL step (transactions -> model-ready table)
    etl = sum(times.get(q, 0.0) for q in ("client_month_panel", "model_ready"))
    n_tx = transactions(spark, sf_dir).count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "warm": warm,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
                      "transactions": n_tx,
                      "etl_rows_per_sec": round(n_tx / etl) if etl else None}))


if __name__ == "__main__":
    main()
