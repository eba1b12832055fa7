"""Exploratory queries over a cleaned frame with file-style column names."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import exploring as ex
from ledgerloom.operators.revenue import distinct_labels
from ledgerloom.plans.cleaning import NOTATIONS, READ_BACK
from ledgerloom.plans.customers import RFM
from ledgerloom.plans.registry import query
from ledgerloom.plans.revenue import MONTH_CELLS, rounded
from ledgerloom.sources.retail import Retail


def cleaned(r: Retail, *columns: str):
    """Order lines as a cleaned file has them: text dates and other column names."""
    rows = r.transactions(*columns).withColumnsRenamed({"revenue": "total_amount", "city": "customer_city"})
    if "order_date" in columns:
        rows = rows.withColumn("order_date", F.date_format("order_date", "dd/MM/yyyy"))
    return ex.explored(rows)


@query("eda_coerce_date", """
SELECT order_id, line_number, strftime(coalesce(
  CASE WHEN regexp_full_match(order_date, '[0-9]{4}-.*') THEN CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) END,
  CAST(try_strptime(order_date, '%d/%m/%Y') AS DATE),
  CASE WHEN NOT regexp_full_match(order_date, '[0-9]{4}-.*') THEN CAST(try_strptime(order_date, '%d-%m-%y') AS DATE) END), '%Y-%m-%d') AS order_date FROM raw
""", raw=True)
def coerce_date(r: Retail):
    day = ex.coerce_date(F.col("order_date"))
    return r.raw("order_id", "line_number", "order_date").withColumn("order_date", F.date_format(day, "yyyy-MM-dd"))


# the explicit formats come first there, and take the first of two numbers for the day
@query("eda_dates_general", READ_BACK.format(otherwise="make_date(year(order_date), day(order_date), month(order_date))"))
def dates_general(r: Retail):
    rows = r.transactions("order_id", "line_number", "order_date").withColumn("order_date", F.expr(NOTATIONS))
    return rows.withColumn("order_date", F.date_format(ex.coerce_date(F.col("order_date")), "yyyy-MM-dd"))


@query("eda_yearly_trend", """
, y AS (SELECT year, CAST(sum(revenue) AS DOUBLE) AS rev FROM star GROUP BY 1)
SELECT year, rev AS revenue, round_even((rev / lag(rev) OVER (ORDER BY year) - 1) * 100 * 1e6, 0) / 1e6 AS pct_growth,
  round_even((regr_intercept(rev, year) OVER () + regr_slope(rev, year) OVER () * year) * 100, 0) / 100 AS trend FROM y
""")
def yearly_trend(r: Retail):
    trend = ex.yearly_trend(cleaned(r, "order_date", "revenue"), *[int(day[:4]) for day in r.span()])
    return rounded(rounded(trend, "trend", places=2), "pct_growth", places=6)


@query("eda_month_heatmap", f"SELECT year, {MONTH_CELLS} FROM star GROUP BY 1")
def month_heatmap(r: Retail):
    return ex.month_heatmap(cleaned(r, "order_date", "revenue"))


OWN = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
OWN_CELLS = ", ".join(f"coalesce(CAST(sum(revenue) FILTER (category = '{c}') AS DOUBLE), 0) AS {c.lower()}" for c in OWN)


@query("eda_category_seasonality", f"SELECT CAST(month(order_date) AS INT) AS month, {OWN_CELLS} FROM transactions GROUP BY 1")
def category_seasonality(r: Retail):
    """The column list is a short label list, read once."""
    found = r.transactions("category")
    names = [row[0] for row in distinct_labels(found, found, "category").collect()]
    return ex.category_seasonality(cleaned(r, "order_date", "revenue", "category"), names)


@query("eda_rfm", RFM + "SELECT customer_id, R, F, M, R_score, F_score, M_score FROM rfm")
def rfm(r: Retail):
    return ex.rfm(cleaned(r, "order_date", "revenue", "customer_id"))


SHARES = """
, p AS (SELECT CAST(year(order_date) AS INT) AS year, payment_method, sum(revenue) AS rev FROM transactions WHERE payment_method IS NOT NULL GROUP BY 1, 2),
q AS (SELECT year, payment_method, CAST(rev AS DOUBLE) AS revenue, CAST(rev AS DOUBLE) / CAST(sum(rev) OVER (PARTITION BY year) AS DOUBLE) AS share FROM p)
"""
METHODS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
METHOD_CELLS = ", ".join(f"coalesce(max(share) FILTER (payment_method = '{m}'), 0) AS s{i}" for i, m in enumerate(METHODS))


@query("eda_payment_share", SHARES + "SELECT * FROM q")
def payment_share(r: Retail):
    return ex.payment_share(cleaned(r, "order_date", "revenue", "payment_method"))


@query("eda_payment_share_matrix", SHARES + f"SELECT year, {METHOD_CELLS} FROM q GROUP BY 1")
def payment_share_matrix(r: Retail):
    return ex.payment_share_matrix(payment_share(r))


@query("eda_category_latest_year", """
SELECT CAST(year(order_date) AS INT) AS year, category, CAST(sum(revenue) AS DOUBLE) AS revenue FROM transactions
WHERE category IS NOT NULL AND year(order_date) = (SELECT max(year(order_date)) FROM transactions WHERE category IS NOT NULL) GROUP BY 1, 2
""")
def category_latest_year(r: Retail):
    return ex.category_latest_year(cleaned(r, "order_date", "revenue", "category"))


@query("eda_prime_aov", """
SELECT is_prime_member AS prime, CAST(sum(revenue) AS DOUBLE) / count(*) AS revenue FROM transactions WHERE is_prime_member IS NOT NULL GROUP BY 1
""")
def prime_aov(r: Retail):
    return ex.prime_aov(cleaned(r, "revenue", "is_prime_member"))


@query("eda_prime_order_frequency", """
SELECT prime, CAST(sum(n) AS DOUBLE) / count(*) AS orders FROM (
  SELECT customer_id, is_prime_member AS prime, count(*) AS n FROM transactions WHERE is_prime_member IS NOT NULL GROUP BY 1, 2) GROUP BY 1
""")
def prime_order_frequency(r: Retail):
    return ex.prime_order_frequency(cleaned(r, "customer_id", "is_prime_member"))


@query("eda_top_cities", "SELECT city, CAST(sum(revenue) AS DOUBLE) AS revenue FROM transactions GROUP BY 1 ORDER BY sum(revenue) DESC, 1 LIMIT 20")
def top_cities(r: Retail):
    return ex.top_cities(cleaned(r, "revenue", "city"))


@query("eda_price_quantity_corr", """
, c AS (SELECT round_even(corr(unit_price, quantity) * 1e6, 0) / 1e6 AS v FROM transactions)
SELECT 'unit_price' AS x, 'unit_price' AS y, 1.0::DOUBLE AS corr UNION ALL SELECT 'quantity', 'quantity', 1.0
UNION ALL SELECT 'unit_price', 'quantity', v FROM c UNION ALL SELECT 'quantity', 'unit_price', v FROM c
""")
def price_quantity_corr(r: Retail):
    return rounded(ex.price_quantity_corr(cleaned(r, "unit_price", "quantity")), "corr", places=6)


@query("eda_delivery_distribution", """
, v AS (SELECT CAST(delivery_days AS DOUBLE) AS v FROM transactions WHERE delivery_days IS NOT NULL),
x AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
n AS (SELECT least(30, CAST(floor((v - lo) * 30 / (hi - lo)) AS INT) + 1) AS bin, count(*) AS n FROM v, x GROUP BY 1)
SELECT CAST(b AS INT) AS bin, lo + (hi - lo) / 30 * (b - 1) AS low, lo + (hi - lo) / 30 * b AS high, coalesce(n, 0) AS n
FROM range(1, 31) AS s(b) CROSS JOIN x LEFT JOIN n ON n.bin = b
""")
def delivery_distribution(r: Retail):
    return ex.delivery_distribution(cleaned(r, "delivery_days"))


@query("eda_delivery_vs_rating", """
SELECT delivery_days, customer_rating, count(*) AS n FROM transactions WHERE delivery_days IS NOT NULL AND customer_rating IS NOT NULL GROUP BY 1, 2
""")
def delivery_vs_rating(r: Retail):
    return ex.delivery_vs_rating(cleaned(r, "delivery_days", "customer_rating"))
