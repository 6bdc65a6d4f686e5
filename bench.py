"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Every query runs over the whole fixture tables and is forced with the
``noop`` sink (full computation, nothing collected to the driver). Each
query is first run once on sf0.001, untimed, so the timings are steady
state (JIT-compiled, classes loaded); plans for the timed scale are still
built, and all data still read, inside the timed run. Prints one JSON
line: {"metric", "value", "unit", "queries", "sf"}.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "user_metrics_table", "segment_country", "segment_plan", "sql_dau", "sql_mau", "sql_retention_4w",
    "sql_funnel", "cohort_retention_wide", "conversion", "churn_summary", "ltv", "revenue_summary",
    "insights_text", "dau_anomalies_by_country", "dau_forecast_by_country", "report_kpi",
    "report_funnel", "auc_of_score", "dq_profile", "churn_scored",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    from usagelens.session import get_spark
    from usagelens.plans.catalog import QUERIES

    spark = get_spark(app="usagelens-bench")
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in names:  # warm-up on the smallest data; not timed
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None}))
    spark.stop()


if __name__ == "__main__":
    main()
