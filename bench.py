"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. ``python bench.py all``
times every registered query instead.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ledgerloom.plans import QUERIES, load_all
from ledgerloom.session import build_session

HEADLINE = [
    "bi_category_share", "bi_kpi_summary", "bi_brand_trend", "bi_monthly_trend", "bi_product_kpis", "bi_category_transitions",
    "bi_cohort_retention", "bi_rfm_scores", "bi_price_bands", "bi_brand_price_positioning", "bi_elasticity",
    "bi_product_associations", "bi_prime_category_mix", "bi_revenue_forecast", "wh_star_view", "wh_fk_violations",
    "wh_append_fact", "cln_run_all", "cln_quality_report", "eda_rfm", "st_mtd_monitor",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                          spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderpriority").count().collect()  # start the executors
    timings = {}
    for key in QUERIES if sys.argv[1:] == ["all"] else HEADLINE:
        started = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[key] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
