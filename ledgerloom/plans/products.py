"""Product, delivery, payment and return reports, pairs and the forecast."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import forecast as fc, products as pd
from ledgerloom.operators.revenue import by_label
from ledgerloom.plans.registry import query
from ledgerloom.plans.revenue import RANGE, iso
from ledgerloom.sources.retail import Retail

BASIC = ("order_date", "date_key", "revenue")
RATED = "CAST(sum(CAST(customer_rating AS DECIMAL(5,2))) AS DOUBLE) / count(customer_rating)"
RETURNED = "CAST(count(*) FILTER (is_returned) AS DOUBLE) / count(*)"


@query("bi_portfolio_growth", """
SELECT launch_year AS year, count(*) AS products FROM products WHERE launch_year IS NOT NULL GROUP BY 1
""")
def portfolio_growth(r: Retail):
    return pd.portfolio_growth(r.products())


@query("bi_product_kpis", f"""
SELECT product_id, coalesce(product_name, product_id) AS product_name, cat AS category, CAST(sum(revenue) AS DOUBLE) AS revenue,
  sum(quantity) AS units, {RATED} AS avg_rating, {RETURNED} AS return_rate
FROM star WHERE {RANGE} GROUP BY 1, 2, 3 ORDER BY sum(revenue) DESC, 1, 3 LIMIT 20
""")
def product_kpis(r: Retail):
    facts = r.transactions(*BASIC, "product_id", "category", "quantity", "customer_rating", "is_returned")
    return pd.product_kpis(facts, r.calendar(), r.products(), *r.span())


@query("bi_demand_monthly", f"""
SELECT year, month, sum(quantity) AS units, year || '-' || month AS period FROM star WHERE {RANGE} GROUP BY 1, 2
""")
def demand_monthly(r: Retail):
    return pd.demand_monthly(r.transactions("order_date", "date_key", "quantity"), r.calendar(), *r.span())


@query("bi_rating_by_category", f"""
SELECT cat AS category, {RATED} AS avg_rating, count(*) AS cnt FROM star WHERE {RANGE} AND customer_rating IS NOT NULL GROUP BY 1
""")
def rating_by_category(r: Retail):
    facts = r.transactions("order_date", "date_key", "product_id", "category", "customer_rating")
    return pd.rating_by_category(facts, r.calendar(), r.products(), *r.span())


@query("bi_recent_launches", "SELECT product_id, product_name, brand, category, launch_year FROM products WHERE launch_year >= 2001 - 3")
def recent_launches(r: Retail):
    return pd.recent_launches(r.products(), 2001)


@query("bi_launch_adoption", """
SELECT s.product_id, year, month, CAST(sum(revenue) AS DOUBLE) AS revenue, year || '-' || month AS period
FROM star s JOIN products p ON p.product_id = s.product_id WHERE p.launch_year >= 2001 - 3 GROUP BY 1, 2, 3
""")
def launch_adoption(r: Retail):
    facts = r.transactions("date_key", "product_id", "revenue")
    return pd.launch_adoption(facts, r.calendar(), pd.recent_launches(r.products(), 2001))


@query("bi_delivery_histogram", f"""
, v AS (SELECT CAST(delivery_days AS DOUBLE) AS v FROM star WHERE {RANGE} AND delivery_days IS NOT NULL),
x AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
n AS (SELECT least(30, CAST(floor((v - lo) * 30 / (hi - lo)) AS INT) + 1) AS bin, count(*) AS n FROM v, x GROUP BY 1)
SELECT CAST(b AS INT) AS bin, lo + (hi - lo) / 30 * (b - 1) AS low, lo + (hi - lo) / 30 * b AS high, coalesce(n, 0) AS n
FROM range(1, 31) AS s(b) CROSS JOIN x LEFT JOIN n ON n.bin = b
""")
def delivery_histogram(r: Retail):
    return pd.delivery_histogram(r.transactions("order_date", "date_key", "delivery_days"), r.calendar(), *r.span())


@query("bi_on_time_rate", f"""
SELECT state, city, CAST(count(*) FILTER (delivery_days <= 3) AS DOUBLE) / count(*) AS on_time
FROM star WHERE {RANGE} AND delivery_days IS NOT NULL GROUP BY 1, 2
""")
def on_time_rate(r: Retail):
    facts = r.transactions("order_date", "date_key", "delivery_days", "state", "city")
    return pd.on_time_rate(facts, r.calendar(), *r.span())


@query("bi_payment_share", f"""
SELECT year, payment_method, CAST(sum(revenue) AS DOUBLE) AS revenue,
  CAST(sum(revenue) AS DOUBLE) / CAST(sum(sum(revenue)) OVER (PARTITION BY year) AS DOUBLE) AS share
FROM star WHERE {RANGE} AND payment_method IS NOT NULL GROUP BY 1, 2
""")
def payment_share(r: Retail):
    return pd.payment_share(r.transactions(*BASIC, "payment_method"), r.calendar(), *r.span())


@query("bi_return_rates", f"""
SELECT cat AS category, {RETURNED} AS return_rate, CAST(sum(revenue) AS DOUBLE) AS revenue, sum(quantity) AS units
FROM star WHERE {RANGE} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50
""")
def return_rates(r: Retail):
    facts = r.transactions(*BASIC, "product_id", "category", "is_returned", "quantity")
    return pd.return_rates(facts, r.calendar(), r.products(), *r.span())


@query("bi_product_associations", f"""
, baskets AS (SELECT list_sort(list_distinct(list(product_id))) AS p FROM star
  WHERE {RANGE} AND order_id IS NOT NULL AND product_id IS NOT NULL GROUP BY order_id),
firsts AS (SELECT p, unnest(range(1, len(p) + 1)) AS i FROM baskets),
couples AS (SELECT p[i] AS prod_a, unnest(p[i + 1:]) AS prod_b FROM firsts)
SELECT prod_a, prod_b, count(*) AS co_occurs FROM couples GROUP BY ALL ORDER BY co_occurs DESC, prod_a, prod_b LIMIT 100
""")
def product_associations(r: Retail):
    return pd.product_pairs(r.transactions("order_id", "product_id", "order_date", "date_key"), r.calendar(), *r.span())


@query("bi_revenue_forecast")
def revenue_forecast(r: Retail):
    """One model for the total and one per category; a year ahead."""
    facts = r.transactions(*BASIC, "product_id", "category")
    months = by_label(facts, r.calendar(), r.products(), "category", *r.span(), ["year", "month"])
    month = F.make_date("year", "month", F.lit(1)).alias("ym")
    each = F.explode(F.array(F.lit("all"), F.col("category"))).alias("series")
    monthly = months.select(each, month, "revenue").groupBy("series", "ym").agg(F.sum("revenue").alias("revenue"))
    return iso(fc.revenue_forecast(monthly), "ym")
