"""Streaming queries over the events table: a value is a sale by a user."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ledgerloom.plans.registry import query
from ledgerloom.plans.revenue import iso
from ledgerloom.session import shared_folder
from ledgerloom.sources.retail import Retail
from ledgerloom.streaming import monitor


def filled_table(r: Retail) -> str:
    """Run the monitor over everything there is and return its table."""
    events = monitor.file_stream(r.spark, r.sf_dir, "events.parquet")
    sales = events.select(monitor.utc_instant(F.col("ts")).alias("ts"), F.col("user_id").cast("string").alias("customer_id"),
                          F.col("value").cast("decimal(18,2)").alias("revenue"))
    base = f"{shared_folder(r.spark)}/monitor-{uuid4().hex}"
    monitor.start_monitor(sales, f"{base}/days", f"{base}/progress").awaitTermination()
    return f"{base}/days"


@query("st_mtd_monitor", """
, s AS (
  SELECT CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(DISTINCT user_id) AS customers, count(*) AS orders
  FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-20'
) SELECT *, revenue / 20 * 31 AS run_rate, revenue / 500000 * 100 AS achieved_pct,
  revenue < CAST(500000 AS DOUBLE) * (CAST(20 AS DOUBLE) / 31) AS behind_target FROM s
""")
def mtd_monitor(r: Retail):
    return monitor.month_to_date(r.spark, filled_table(r), "2024-01-20", 500_000)


@query("st_daily_revenue", """
SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM events WHERE year(ts) = 2024 AND month(ts) = 1 GROUP BY 1
""")
def daily_revenue(r: Retail):
    return iso(monitor.daily_revenue(r.spark, filled_table(r), 2024, 1))
