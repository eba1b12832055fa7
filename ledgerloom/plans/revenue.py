"""Revenue reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.numeric import half_even
from ledgerloom.operators import revenue as rv
from ledgerloom.plans.registry import query
from ledgerloom.sources.retail import Retail

BASIC = ("order_date", "date_key", "revenue")
PICKED = ["PROMO", "SMALL", "LARGE"]
RANGE = "date BETWEEN (SELECT min(date) FROM time_dimension) AND (SELECT max(date) FROM time_dimension)"


def iso(df, name="date"):
    return df.withColumn(name, F.date_format(name, "yyyy-MM-dd"))


def rounded(df, *names, places=4):
    """Fitted values differ between engines in their last bits."""
    return df.withColumns({n: half_even(F.col(n), places) for n in names})


@query("bi_category_list", """
SELECT DISTINCT category FROM products WHERE category IS NOT NULL UNION SELECT DISTINCT category FROM transactions WHERE category IS NOT NULL
""")
def category_list(r: Retail):
    return rv.distinct_labels(r.products(), r.transactions("category"), "category")


@query("bi_brand_list", """
SELECT brand FROM products WHERE category IN ('PROMO', 'SMALL', 'LARGE') AND brand IS NOT NULL
UNION SELECT brand FROM transactions WHERE category IN ('PROMO', 'SMALL', 'LARGE') AND brand IS NOT NULL
""")
def brand_list(r: Retail):
    return rv.distinct_labels(r.products(), r.transactions("brand", "category"), "brand", PICKED)


@query("bi_kpi_summary", f"""
SELECT CAST(sum(revenue) AS DOUBLE) AS revenue, count(DISTINCT customer_id) AS active_customers,
  CAST(sum(revenue) AS DOUBLE) / count(*) AS aov
FROM star WHERE {RANGE} AND p_category IN ('PROMO', 'SMALL', 'LARGE')
""")
def kpi_summary(r: Retail):
    return rv.kpi_summary(r.transactions(*BASIC, "customer_id", "product_id"), r.calendar(), r.products(), *r.span(), PICKED)


@query("bi_revenue_yoy", """
, s AS (
  SELECT coalesce(CAST(sum(revenue) FILTER (date BETWEEN DATE '2000-02-29' AND DATE '2001-01-31') AS DOUBLE), 0) AS revenue,
    coalesce(CAST(sum(revenue) FILTER (date BETWEEN DATE '1999-02-28' AND DATE '2000-01-31') AS DOUBLE), 0) AS previous FROM star
) SELECT *, (revenue - previous) / nullif(previous, 0) * 100 AS delta_pct FROM s
""")
def revenue_yoy(r: Retail):
    return rv.revenue_yoy(r.transactions(*BASIC), r.calendar(), "2000-02-29", "2001-01-31")


@query("bi_revenue_by_year", f"""
SELECT year, CAST(sum(revenue) AS DOUBLE) AS revenue FROM star WHERE {RANGE} AND p_category IN ('PROMO', 'SMALL', 'LARGE') GROUP BY 1
""")
def revenue_by_year(r: Retail):
    return rv.revenue_by_year(r.transactions(*BASIC, "product_id"), r.calendar(), r.products(), *r.span(), PICKED)


@query("bi_top_categories", f"""
SELECT cat AS category, CAST(sum(revenue) AS DOUBLE) AS revenue FROM star WHERE {RANGE} GROUP BY 1 ORDER BY sum(revenue) DESC, 1 LIMIT 10
""")
def top_categories(r: Retail):
    return rv.top_categories(r.transactions(*BASIC, "product_id", "category"), r.calendar(), r.products(), *r.span())


@query("bi_mtd_metrics", """
, s AS (
  SELECT CAST(sum(revenue) AS DOUBLE) AS revenue, count(DISTINCT customer_id) AS customers, count(*) AS orders
  FROM star WHERE date BETWEEN DATE '2001-07-01' AND DATE '2001-07-20'
) SELECT *, revenue / 20 * 31 AS run_rate, revenue / 10000000 * 100 AS achieved_pct,
  revenue < CAST(10000000 AS DOUBLE) * (CAST(20 AS DOUBLE) / 31) AS behind_target FROM s
""")
def mtd_metrics(r: Retail):
    return rv.mtd_metrics(r.transactions(*BASIC, "customer_id"), r.calendar(), "2001-07-20", 10_000_000)


@query("bi_daily_revenue_month", """
SELECT strftime(date, '%Y-%m-%d') AS date, CAST(sum(revenue) AS DOUBLE) AS revenue FROM star WHERE year = 2001 AND month = 7 GROUP BY 1
""")
def daily_revenue_month(r: Retail):
    return iso(rv.daily_revenue(r.transactions("date_key", "revenue"), r.calendar(), 2001, 7))


@query("bi_brand_share_dim", """
, s AS (SELECT coalesce(p_brand_only, 'Unknown') AS brand, sum(revenue) AS rev FROM star GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
SELECT brand, CAST(rev AS DOUBLE) AS revenue, CAST(rev AS DOUBLE) / CAST(sum(rev) OVER () AS DOUBLE) AS share FROM s
""")
def brand_share_dim(r: Retail):
    return rv.brand_share_by_product(r.transactions("product_id", "revenue"), r.products())


@query("bi_geo_expansion", """
SELECT year, state, count(DISTINCT city) AS cities, CAST(sum(revenue) AS DOUBLE) AS revenue FROM star GROUP BY 1, 2
""")
def geo_expansion(r: Retail):
    return rv.geo_expansion(r.transactions("date_key", "revenue", "state", "city"), r.calendar())


@query("bi_cities_covered", """
SELECT year, CAST(sum(c) AS BIGINT) AS cities FROM (SELECT year, state, count(DISTINCT city) AS c FROM star GROUP BY 1, 2) GROUP BY 1
""")
def cities_covered(r: Retail):
    return rv.cities_covered(r.transactions("date_key", "revenue", "state", "city"), r.calendar())


@query("bi_revenue_by_category_dim", """
SELECT coalesce(p_category, 'Unknown') AS category, CAST(sum(revenue) AS DOUBLE) AS revenue FROM star GROUP BY 1 ORDER BY sum(revenue) DESC, 1 LIMIT 20
""")
def revenue_by_category_dim(r: Retail):
    return rv.revenue_by_category_of_product(r.transactions("product_id", "revenue"), r.products())


LINE = "regr_intercept(rev, idx) OVER () + regr_slope(rev, idx) OVER () * idx"


@query("bi_monthly_trend", f"""
, m AS (SELECT year, month, CAST(sum(revenue) AS DOUBLE) AS rev FROM star GROUP BY 1, 2),
i AS (SELECT *, row_number() OVER (ORDER BY year, month) - 1 AS idx, count(*) OVER () AS n FROM m)
SELECT year, month, rev AS revenue, CAST(idx AS INT) AS period,
  CASE WHEN n >= 6 THEN round_even(({LINE}) * 10000, 0) / 10000 END AS trend FROM i
""")
def monthly_trend(r: Retail):
    return rounded(rv.monthly_trend(r.transactions("date_key", "revenue"), r.calendar()), "trend")


@query("bi_revenue_trend", f"""
, m AS (SELECT year, quarter, CAST(sum(revenue) AS DOUBLE) AS rev FROM star WHERE {RANGE} AND cat IN ('PROMO', 'SMALL', 'LARGE') GROUP BY 1, 2),
i AS (SELECT *, row_number() OVER (ORDER BY year, quarter) - 1 AS idx, count(*) OVER () AS n FROM m)
SELECT year, quarter, rev AS revenue, CAST(idx AS INT) AS period_idx,
  CASE WHEN n >= 2 THEN round_even(({LINE}) * 10000, 0) / 10000 END AS trend FROM i
""")
def revenue_trend(r: Retail):
    facts = r.transactions(*BASIC, "product_id", "category")
    return rounded(rv.revenue_trend(facts, r.calendar(), r.products(), *r.span(), "quarter", PICKED), "trend")


@query("bi_growth_rates", f"""
, m AS (SELECT year, month, CAST(sum(revenue) AS DOUBLE) AS rev FROM star WHERE {RANGE} GROUP BY 1, 2),
g AS (SELECT *, lag(rev) OVER (ORDER BY year, month) AS prev FROM m)
SELECT year, month, round_even(rev * 100, 0) / 100 AS revenue, round_even(prev * 100, 0) / 100 AS previous,
  round_even((rev - prev) / nullif(prev, 0) * 100 * 100, 0) / 100 AS growth_pct FROM g
""")
def growth_rates(r: Retail):
    return rv.growth_rates(r.transactions(*BASIC), r.calendar(), r.products(), *r.span())


@query("bi_seasonal_pattern", f"""
, m AS (SELECT year, month, sum(revenue) AS rev FROM star WHERE {RANGE} AND cat IN ('PROMO', 'SMALL', 'LARGE') GROUP BY 1, 2)
SELECT month, CAST(sum(rev) AS DOUBLE) / count(*) AS avg_month_rev FROM m GROUP BY 1
""")
def seasonal_pattern(r: Retail):
    facts = r.transactions(*BASIC, "product_id", "category")
    return rv.seasonal_pattern(facts, r.calendar(), r.products(), *r.span(), PICKED)


@query("bi_category_share", f"""
SELECT cat AS category, CAST(sum(revenue) AS DOUBLE) AS revenue,
  CAST(sum(revenue) AS DOUBLE) / CAST(sum(sum(revenue)) OVER () AS DOUBLE) AS share FROM star WHERE {RANGE} GROUP BY 1
""")
def category_share(r: Retail):
    return rv.category_share(r.transactions(*BASIC, "product_id", "category"), r.calendar(), r.products(), *r.span())


@query("bi_category_trend_share", f"""
SELECT year, cat AS category, CAST(sum(revenue) AS DOUBLE) AS revenue,
  CAST(sum(revenue) AS DOUBLE) / CAST(sum(sum(revenue)) OVER (PARTITION BY year) AS DOUBLE) AS share FROM star WHERE {RANGE} GROUP BY 1, 2
""")
def category_trend_share(r: Retail):
    return rv.category_trend_share(r.transactions(*BASIC, "product_id", "category"), r.calendar(), r.products(), *r.span())


@query("bi_state_revenue", f"""
SELECT coalesce(state, 'Unknown') AS state, CAST(sum(revenue) AS DOUBLE) AS revenue FROM star WHERE {RANGE} GROUP BY 1
""")
def state_revenue(r: Retail):
    return rv.place_revenue(r.transactions(*BASIC, "state"), r.calendar(), *r.span(), "state")


@query("bi_city_revenue", f"""
SELECT coalesce(city, 'Unknown') AS city, CAST(sum(revenue) AS DOUBLE) AS revenue FROM star WHERE {RANGE}
GROUP BY 1 ORDER BY sum(revenue) DESC, 1 LIMIT 50
""")
def city_revenue(r: Retail):
    return rv.place_revenue(r.transactions(*BASIC, "city"), r.calendar(), *r.span(), "city", 50)


FESTIVAL_DAYS = """
, spans AS (
  SELECT 'Diwali' AS festival, CAST(y AS INT) AS year, make_date(y, 11, 1) AS a, make_date(y, 11, 14) AS b FROM range(1995, 2002) AS s(y)
  UNION ALL SELECT 'Prime Day', CAST(y AS INT), make_date(y, 7, 15), make_date(y, 7, 16) FROM range(1995, 2002) AS s(y)
  UNION ALL SELECT 'New Year', 1998, DATE '1998-01-01', DATE '1998-01-07'
), labelled AS (
  SELECT festival, s.year, date, CASE WHEN date < a THEN 'before' WHEN date > b THEN 'after' ELSE 'during' END AS period
  FROM spans s JOIN time_dimension d ON d.date BETWEEN a - 7 AND b + 7
)"""


def festival_days(r: Retail):
    return rv.festival_days(r.calendar(), range(1995, 2002), 7, {"New Year": ("1998-01-01", "1998-01-07")})


@query("bi_festival_windows", FESTIVAL_DAYS + """
SELECT festival, l.year, period, strftime(l.date, '%Y-%m-%d') AS date, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM labelled l JOIN star s ON s.date = l.date GROUP BY 1, 2, 3, 4
""")
def festival_windows(r: Retail):
    return iso(rv.festival_windows(r.transactions("date_key", "revenue"), festival_days(r)))


@query("bi_festival_summary", FESTIVAL_DAYS + """
SELECT festival, l.year, period, coalesce(CAST(sum(revenue) AS DOUBLE), 0) AS revenue
FROM labelled l LEFT JOIN star s ON s.date = l.date GROUP BY 1, 2, 3
""")
def festival_summary(r: Retail):
    return rv.festival_summary(r.transactions("date_key", "revenue"), festival_days(r))


@query("bi_brand_share", f"""
, s AS (SELECT br AS brand, sum(revenue) AS rev FROM star WHERE {RANGE} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)
SELECT brand, CAST(rev AS DOUBLE) AS revenue, CAST(rev AS DOUBLE) / CAST(sum(rev) OVER () AS DOUBLE) AS share FROM s
""")
def brand_share(r: Retail):
    return rv.brand_share(r.transactions(*BASIC, "product_id", "brand"), r.calendar(), r.products(), *r.span())


@query("bi_brand_trend", f"SELECT year, br AS brand, CAST(sum(revenue) AS DOUBLE) AS revenue FROM star WHERE {RANGE} GROUP BY 1, 2")
def brand_trend(r: Retail):
    return rv.brand_trend(r.transactions(*BASIC, "product_id", "brand"), r.calendar(), r.products(), *r.span())


MONTH_CELLS = ", ".join(
    f"coalesce(CAST(sum(revenue) FILTER (month = {m}) AS DOUBLE), 0) AS m{m}" for m in range(1, 13))


@query("bi_seasonal_matrix", f"SELECT year, {MONTH_CELLS} FROM star GROUP BY 1")
def seasonal_matrix(r: Retail):
    return rv.seasonal_matrix(r.transactions("date_key", "revenue"), r.calendar())


@query("bi_command_summary", f"""
SELECT CAST(sum(revenue) AS DOUBLE) AS revenue, count(*) AS orders, count(DISTINCT customer_id) AS customers FROM star WHERE {RANGE}
""")
def command_summary(r: Retail):
    return rv.command_summary(r.transactions(*BASIC, "customer_id"), r.calendar(), *r.span())
