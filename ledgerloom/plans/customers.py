"""Customer reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import customers as cu
from ledgerloom.operators.revenue import top
from ledgerloom.plans.registry import query
from ledgerloom.plans.revenue import RANGE, iso
from ledgerloom.session import cut_lineage
from ledgerloom.sources.retail import Retail

BASIC = ("order_date", "date_key", "customer_id", "revenue")

RFM = f"""
, o AS (SELECT customer_id, date, revenue FROM star WHERE {RANGE} AND customer_id IS NOT NULL),
g AS (SELECT customer_id, CAST((SELECT max(date) FROM o) - max(date) AS INT) AS R, count(*) AS F, sum(revenue) AS M FROM o GROUP BY 1),
k AS (SELECT *, count(*) OVER () AS n,
  row_number() OVER (ORDER BY R, md5(customer_id), customer_id) AS rr, row_number() OVER (ORDER BY F, md5(customer_id), customer_id) AS rf,
  row_number() OVER (ORDER BY M, md5(customer_id), customer_id) AS rm FROM g),
scored AS (SELECT customer_id, R, F, CAST(M AS DOUBLE) AS M, M AS exact_m,
  CAST(greatest(1, (5 * (n - rr) + n - 1) // n) AS INT) AS R_score, CAST((5 * rf + n - 1) // n AS INT) AS F_score,
  CAST((5 * rm + n - 1) // n AS INT) AS M_score FROM k),
rfm AS (SELECT *, CAST(R_score AS VARCHAR) || F_score || M_score AS segment FROM scored)
"""


def rfm_of(r: Retail):
    return cu.rfm(r.transactions(*BASIC), r.calendar(), *r.span())


@query("bi_new_customers", """
SELECT CAST(year(f) AS INT) AS year, count(*) AS new_customers
FROM (SELECT customer_id, min(date) AS f FROM star WHERE customer_id IS NOT NULL GROUP BY 1) GROUP BY 1
""")
def new_customers(r: Retail):
    return cu.new_customers(r.transactions("date_key", "customer_id"), r.calendar())


@query("bi_rfm_scores", RFM + "SELECT customer_id, R, F, M, R_score, F_score, M_score, segment FROM rfm")
def rfm_scores(r: Retail):
    return rfm_of(r)


@query("bi_rfm_summary", RFM + """
SELECT count(*) AS customers, round_even(quantile_cont(M, 0.5) * 1e4, 0) / 1e4 AS median_monetary,
  quantile_cont(CAST(F AS DOUBLE), 0.5) AS median_frequency FROM rfm
""")
def rfm_summary(r: Retail):
    from ledgerloom.plans.revenue import rounded
    base = cu.rfm_base(cu.orders_in_range(r.transactions(*BASIC), r.calendar(), *r.span()))
    return rounded(cu.rfm_summary(base), "median_monetary")


@query("bi_rfm_segments", RFM + "SELECT segment, count(*) AS customers FROM rfm GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def rfm_segments(r: Retail):
    return cu.rfm_segments(rfm_of(r))


@query("bi_rfm_drilldown", RFM + """
SELECT customer_id, R, F, M, R_score, F_score, M_score, segment FROM rfm WHERE segment = '555' ORDER BY exact_m DESC, customer_id LIMIT 200
""")
def rfm_drilldown(r: Retail):
    return cu.rfm_drilldown(rfm_of(r), "555")


TRANSITIONS = f"""
, steps AS (SELECT cat AS cat_from, lead(cat) OVER (PARTITION BY customer_id ORDER BY date, tx_id) AS cat_to
  FROM star WHERE {RANGE} AND customer_id IS NOT NULL),
pairs AS (SELECT cat_from, cat_to, count(*) AS transitions FROM steps WHERE cat_to IS NOT NULL GROUP BY ALL)
"""


def transitions_of(r: Retail):
    facts = r.transactions("customer_id", "product_id", "category", "order_date", "date_key", "tx_id", "tx_slice")
    return cu.category_transitions(facts, r.calendar(), r.products(), *r.span())


@query("bi_category_transitions", TRANSITIONS + "SELECT * FROM pairs")
def category_transitions(r: Retail):
    return transitions_of(r)


CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "Unknown"]
STEP_CELLS = ", ".join(
    f"CAST(coalesce(sum(transitions) FILTER (cat_to = '{c}'), 0) AS BIGINT) AS {c.lower()}" for c in CATEGORIES)


@query("bi_transition_matrix", TRANSITIONS + f"SELECT cat_from, {STEP_CELLS} FROM pairs GROUP BY 1")
def transition_matrix(r: Retail):
    """The columns are the labels that the counted pairs have: a short list, read from their written table."""
    pairs = cut_lineage(transitions_of(r))
    seen = pairs.select(F.explode(F.array("cat_from", "cat_to")).alias("c")).distinct().collect()
    return cu.transition_matrix(pairs, sorted(row["c"] for row in seen))


@query("bi_top_transitions", TRANSITIONS + "SELECT * FROM pairs ORDER BY transitions DESC, cat_from, cat_to LIMIT 50")
def top_transitions(r: Retail):
    return top(transitions_of(r), "transitions", "cat_from", "cat_to", n=50)


@query("bi_prime_metrics", f"""
SELECT prime, count(*) AS orders, count(DISTINCT customer_id) AS customers, CAST(sum(revenue) AS DOUBLE) AS revenue,
  CAST(sum(revenue) AS DOUBLE) / count(*) AS aov,
  CAST(sum(revenue) AS DOUBLE) / greatest(1, CAST(sum(sum(revenue)) OVER () AS DOUBLE)) * 100 AS revenue_share_pct
FROM star WHERE {RANGE} GROUP BY 1
""")
def prime_metrics(r: Retail):
    return cu.prime_metrics(r.transactions(*BASIC, "is_prime_member"), r.calendar(), r.customers(), *r.span())


@query("bi_prime_category_mix", f"""
SELECT prime, cat AS category, CAST(sum(revenue) AS DOUBLE) AS revenue,
  CAST(sum(revenue) AS DOUBLE) / CAST(sum(sum(revenue)) OVER (PARTITION BY cat) AS DOUBLE) AS share FROM star WHERE {RANGE} GROUP BY 1, 2
""")
def prime_category_mix(r: Retail):
    facts = r.transactions(*BASIC, "is_prime_member", "product_id", "category")
    return cu.prime_category_mix(facts, r.calendar(), r.products(), r.customers(), *r.span())


COHORTS = f"""
, o AS (SELECT DISTINCT customer_id, year * 12 + month - 1 AS ym FROM star WHERE {RANGE} AND customer_id IS NOT NULL),
l AS (SELECT customer_id, ym, min(ym) OVER (PARTITION BY customer_id) AS c FROM o),
active AS (SELECT strftime(make_date(c // 12, c % 12 + 1, 1), '%Y-%m-%d') AS cohort, CAST(ym - c AS INT) AS m, count(*) AS active FROM l GROUP BY 1, 2)
"""


def cohorts_of(r: Retail):
    return cu.cohort_active(r.transactions("order_date", "date_key", "customer_id"), r.calendar(), *r.span())


@query("bi_cohort_active", COHORTS + "SELECT * FROM active")
def cohort_active(r: Retail):
    return iso(cohorts_of(r), "cohort")


# offsets between the first and the last month of the range
#: the matrix has a column for each of so many months after the first; the long form has them all
MONTHS = 83
OFFSET_CELLS = ", ".join(f"CAST(coalesce(sum(active) FILTER (m = {i}), 0) AS BIGINT) AS m{i}" for i in range(MONTHS + 1))


@query("bi_cohort_matrix", COHORTS + f"SELECT cohort, {OFFSET_CELLS} FROM active GROUP BY 1")
def cohort_matrix(r: Retail):
    return iso(cu.cohort_matrix(cohorts_of(r), MONTHS), "cohort")


@query("bi_cohort_retention", COHORTS + """
SELECT c.cohort, o.m, round_even(coalesce(CAST(a.active AS DOUBLE) / z.active * 100, 0) * 10, 0) / 10 AS retention_pct
FROM (SELECT DISTINCT cohort FROM active) c CROSS JOIN (SELECT DISTINCT m FROM active) o
JOIN active z ON z.cohort = c.cohort AND z.m = 0 LEFT JOIN active a ON a.cohort = c.cohort AND a.m = o.m
""")
def cohort_retention(r: Retail):
    return iso(cu.cohort_retention(cohorts_of(r)), "cohort")


@query("bi_age_revenue", f"""
SELECT coalesce(age_group, 'Unknown') AS age_group, CAST(sum(revenue) AS DOUBLE) AS revenue FROM star WHERE {RANGE} GROUP BY 1
""")
def age_revenue(r: Retail):
    return cu.age_revenue(r.transactions(*BASIC), r.calendar(), r.customers(), *r.span())


@query("bi_age_category_mix", f"""
SELECT coalesce(age_group, 'Unknown') AS age_group, cat AS category, CAST(sum(revenue) AS DOUBLE) AS revenue,
  CAST(sum(revenue) AS DOUBLE) / CAST(sum(sum(revenue)) OVER (PARTITION BY cat) AS DOUBLE) AS share FROM star WHERE {RANGE} GROUP BY 1, 2
""")
def age_category_mix(r: Retail):
    facts = r.transactions(*BASIC, "product_id", "category")
    return cu.age_category_mix(facts, r.calendar(), r.products(), r.customers(), *r.span())
