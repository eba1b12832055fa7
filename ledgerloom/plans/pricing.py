"""Price and discount reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.numeric import half_even
from ledgerloom.operators import pricing as pr
from ledgerloom.plans.registry import query
from ledgerloom.plans.revenue import PICKED, RANGE, rounded
from ledgerloom.sources.retail import Retail

LINES = ("order_date", "date_key", "product_id", "category", "brand", "unit_price", "quantity")


def price_rows(r: Retail, categories=None, brands=None):
    return pr.price_demand(r.transactions(*LINES), r.calendar(), r.products(), *r.span(), categories, brands)


@query("bi_price_demand", f"""
SELECT cat AS category, br AS brand, unit_price, quantity FROM star
WHERE {RANGE} AND unit_price IS NOT NULL AND quantity IS NOT NULL AND cat IN ('PROMO', 'SMALL', 'LARGE')
  AND br IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5')
""")
def price_demand(r: Retail):
    return price_rows(r, PICKED, [f"Brand#{i}" for i in range(1, 6)])


@query("bi_price_demand_fit", f"""
SELECT cat AS category, round_even(regr_slope(quantity, unit_price) * 1e9, 0) / 1e9 AS slope,
  round_even(regr_intercept(quantity, unit_price) * 1e6, 0) / 1e6 AS intercept, count(*) AS n FROM star WHERE {RANGE} GROUP BY 1
""")
def price_demand_fit(r: Retail):
    return rounded(rounded(pr.price_demand_fit(price_rows(r)), "slope", places=9), "intercept", places=6)


@query("bi_elasticity", f"""
, l AS (SELECT cat, ln(quantity + 1e-6) AS y, ln(unit_price + 1e-6) AS x FROM star WHERE {RANGE}),
g AS (SELECT cat, count(*) AS n, regr_slope(y, x) AS b, regr_r2(y, x) AS r2, var_pop(y) AS v FROM l GROUP BY 1)
SELECT cat AS category, n, round_even(b * 1e6, 0) / 1e6 AS elasticity, CASE WHEN v > 0 THEN round_even(r2 * 1e6, 0) / 1e6 END AS r2
FROM g WHERE n >= 30
""")
def elasticity(r: Retail):
    return rounded(pr.elasticity(price_rows(r)), "elasticity", "r2", places=6)


BUCKETED = f"""
, b AS (
  SELECT *, CAST(CASE WHEN coalesce(discount_pct, 0) < 0 THEN 0 WHEN coalesce(discount_pct, 0) >= 8 THEN 7
    ELSE CAST(floor(coalesce(discount_pct, 0) * 6 / 8) AS INT) + 1 END AS INT) AS disc_bucket
  FROM star WHERE {RANGE} AND p_category IN ('PROMO', 'SMALL', 'LARGE')
)"""


@query("bi_discount_effect", BUCKETED + """
SELECT cat AS category, disc_bucket, disc_bucket * (CAST(8 AS DOUBLE) / 6) AS disc_label,
  CAST(sum(CAST(discount_pct AS DECIMAL(9,4))) AS DOUBLE) / count(discount_pct) AS avg_disc,
  sum(quantity) AS units, CAST(sum(revenue) AS DOUBLE) AS revenue FROM b GROUP BY 1, 2
""")
def discount_effect(r: Retail):
    facts = r.transactions("order_date", "date_key", "product_id", "category", "discount_pct", "quantity", "revenue")
    return pr.discount_effect(facts, r.calendar(), r.products(), *r.span(), 8, 6, PICKED)


BUCKET_CELLS = ", ".join(f"coalesce(CAST(sum(revenue) FILTER (disc_bucket = {b}) AS DOUBLE), 0) AS b{b}" for b in range(8))


@query("bi_discount_matrix", BUCKETED + f"SELECT cat AS category, {BUCKET_CELLS} FROM b GROUP BY 1")
def discount_matrix(r: Retail):
    return pr.discount_matrix(discount_effect(r), 6)


PROBS = ", ".join(repr(i * 0.1) for i in range(10)) + ", 1.0"


@query("bi_price_bands", f"""
, e AS (SELECT cat, quantile_cont(unit_price, CAST([{PROBS}] AS DOUBLE[])) AS q, count(*) AS n FROM star WHERE {RANGE} GROUP BY 1),
d AS (SELECT cat, list_sort(list_distinct(q)) AS q FROM e WHERE n >= 30),
p AS (SELECT d.cat, d.q, len(list_filter(d.q[2:len(d.q) - 1], lambda x: x < unit_price)) + 1 AS band, quantity, unit_price
  FROM star s JOIN d ON d.cat = s.cat WHERE {RANGE})
SELECT cat AS category, CAST(band AS INT) AS band, round_even(q[band] * 1e6, 0) / 1e6 AS low,
  round_even(q[band + 1] * 1e6, 0) / 1e6 AS high, sum(quantity) AS units,
  round_even(sum(unit_price * quantity) * 100, 0) / 100 AS revenue FROM p GROUP BY 1, 2, 3, 4
""")
def price_bands(r: Retail):
    return rounded(rounded(pr.price_bands(price_rows(r)), "low", "high", places=6), "revenue", places=2)


@query("bi_brand_positioning", f"""
, g AS (SELECT cat, br, quantile_cont(unit_price, 0.5) AS m, sum(quantity) AS u FROM star WHERE {RANGE} GROUP BY 1, 2)
SELECT cat AS category, br AS brand, round_even(m * 1e6, 0) / 1e6 AS median_price, u AS units,
  round_even(u * m * 100, 0) / 100 AS revenue FROM g
""")
def brand_positioning(r: Retail):
    return rounded(rounded(pr.brand_positioning(price_rows(r)), "median_price", places=6), "revenue", places=2)


@query("bi_brand_price_positioning", """
SELECT br AS brand, cat AS category, round_even(quantile_cont(unit_price, 0.5) * 1e6, 0) / 1e6 AS median_price, sum(quantity) AS units
FROM star WHERE unit_price IS NOT NULL GROUP BY 1, 2
""")
def brand_price_positioning(r: Retail):
    facts = r.transactions("product_id", "category", "brand", "unit_price", "quantity")
    return rounded(pr.brand_price_positioning(facts, r.products()), "median_price", places=6)
