"""Warehouse queries."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ledgerloom.operators import warehouse as wh
from ledgerloom.plans.registry import query
from ledgerloom.session import shared_folder
from ledgerloom.sources.retail import Retail


@query("wh_time_dimension", """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INT) AS date_key, strftime(d, '%Y-%m-%d') AS date,
  CAST(day(d) AS INT) AS day, CAST(month(d) AS INT) AS month, monthname(d) AS month_name,
  CAST(quarter(d) AS INT) AS quarter, 'Q' || quarter(d) AS quarter_name, CAST(year(d) AS INT) AS year,
  CAST(weekofyear(d) AS INT) AS week_iso, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend,
  CAST(CASE WHEN month(d) >= 4 THEN year(d) ELSE year(d) - 1 END AS INT) AS fiscal_year,
  CAST(((month(d) - 4 + 12) % 12) // 3 + 1 AS INT) AS fiscal_quarter
FROM generate_series((SELECT date_trunc('year', min(o_orderdate)) FROM orders),
                     (SELECT CAST(max(o_orderdate) AS DATE) FROM orders), INTERVAL 1 DAY) AS s(d)
""")
def time_dimension(r: Retail):
    """The calendar from the first order year's start to the last order day, merged onto the range before 1998."""
    span = r.table("orders").agg(
        F.trunc(F.min("o_orderdate"), "year").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    bounds = span.first()
    older = wh.time_dimension(r.spark, str(bounds["a"]), "1997-12-31")
    full = wh.time_dimension(r.spark, str(bounds["a"]), str(bounds["b"]))
    return wh.merge_calendar(older, full).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


LOOSE_NAMES = {
    "order_id": "transaction_id", "order_date": "date", "customer_id": "cust_id", "product_id": "sku",
    "revenue": "amount", "quantity": "qty", "city": "customer_city", "is_prime_member": "prime",
}


@query("wh_pick_columns", """
SELECT order_id, strftime(order_date, '%Y-%m-%d') AS order_date, customer_id, product_id, CAST(revenue AS DOUBLE) AS revenue,
  quantity, unit_price, category, city, is_prime_member, CAST(NULL AS VARCHAR) AS brand, CAST(NULL AS VARCHAR) AS payment_method
FROM transactions
""")
def pick_columns(r: Retail):
    given = r.transactions("order_id", "order_date", "customer_id", "product_id", "revenue", "quantity", "unit_price",
                           "category", "city", "is_prime_member").withColumnsRenamed(LOOSE_NAMES)
    return wh.pick_columns(given).select(
        "order_id", F.date_format("order_date", "yyyy-MM-dd").alias("order_date"), "customer_id", "product_id", "revenue",
        "quantity", "unit_price", "category", "city", "is_prime_member", "brand", "payment_method")


@query("wh_normalize_fact", """
, parsed AS (
  SELECT *, CASE WHEN regexp_full_match(order_date, '\\d{4}-\\d{2}-\\d{2}') THEN CAST(order_date AS DATE) END AS d FROM raw
)
SELECT order_id, line_number, customer_id, product_id, strftime(d, '%Y-%m-%d') AS order_date,
  CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INT) AS date_key,
  CAST(try_cast(quantity AS DECIMAL(18,3)) AS DOUBLE) AS quantity, CAST(try_cast(price AS DECIMAL(18,2)) AS DOUBLE) AS revenue,
  CAST(try_cast(price AS DECIMAL(18,2)) AS DOUBLE) AS unit_price,
  category, payment AS payment_method, city,
  CASE WHEN lower(prime) IN ('true','t','yes','y','1') THEN true WHEN lower(prime) IN ('false','f','no','n','0') THEN false END AS is_prime_member,
  CAST(try_cast(delivery AS DECIMAL(10,2)) AS INT) AS delivery_days, CAST(try_cast(rating AS DECIMAL(5,2)) AS DOUBLE) AS customer_rating,
  'orders_' || coalesce(CAST(year(d) AS VARCHAR), 'undated') || '.csv' AS source_file
FROM parsed
""", raw=True)
def normalize_fact(r: Retail):
    given = r.raw().withColumns({"delivery_days": F.col("delivery"), "revenue": F.col("price")}).drop("delivery", "tx_id")
    year = F.year(wh.parse_iso(F.col("order_date")))
    name = F.concat(F.lit("orders_"), F.coalesce(year.cast("string"), F.lit("undated")), F.lit(".csv"))
    rows = with_line_number(given, name)
    return rows.select(
        "order_id", "line_number", "customer_id", "product_id", F.date_format("order_date", "yyyy-MM-dd").alias("order_date"),
        "date_key", "quantity", "revenue", "unit_price", "category", "payment_method", "city", "is_prime_member",
        "delivery_days", "customer_rating", "source_file")


def with_line_number(given, name):
    """Carry the line number through the order id, which the fact keeps as text."""
    packed = given.withColumn("order_id", F.concat_ws("|", "order_id", "line_number"))
    rows = wh.normalize_fact(packed, name)
    parts = F.split("order_id", r"\|")
    return rows.withColumns({"line_number": parts[1], "order_id": parts[0]})


@query("wh_upsert_products_min", """
SELECT product_id, product_name, brand, category, launch_year, CAST(base_price_2015 AS DOUBLE) AS base_price_2015 FROM products
UNION ALL
SELECT DISTINCT product_id, NULL, NULL, NULL, NULL, NULL FROM transactions t
WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = t.product_id)
""")
def upsert_product_ids(r: Retail):
    return wh.upsert_product_ids(r.products(), r.transactions("product_id"))


@query("wh_upsert_customers", """
, existing AS (SELECT customer_id, city, state, is_prime_member FROM customers WHERE segment = 'BUILDING')
SELECT * FROM existing
UNION ALL
SELECT customer_id, city, state, is_prime_member FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY tx_id) AS rn FROM transactions
  WHERE customer_id NOT IN (SELECT customer_id FROM existing)
) WHERE rn = 1
""")
def upsert_customers(r: Retail):
    existing = r.customers().filter(F.col("segment") == "BUILDING").select("customer_id", "city", "state", "is_prime_member")
    facts = r.transactions("customer_id", "city", "state", "is_prime_member", "order_date", "tx_id")
    return wh.upsert_customers(existing, facts, F.struct("order_date", "tx_id"))


@query("wh_upsert_products_coalesce", """
, incoming AS (
  SELECT CAST(l_partkey AS VARCHAR) AS product_id, p_name || ' v2' AS product_name,
    CASE WHEN l_linenumber > 3 THEN 'Line ' || l_linenumber END AS subcategory,
    row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice) AS rn
  FROM lineitem JOIN part ON l_partkey = p_partkey
)
SELECT coalesce(i.product_id, p.product_id) AS product_id, coalesce(i.product_name, p.product_name) AS product_name,
  p.brand, p.category, i.subcategory, p.launch_year, CAST(p.base_price_2015 AS DOUBLE) AS base_price_2015
FROM products p FULL JOIN (SELECT * FROM incoming WHERE rn = 1) i ON i.product_id = p.product_id
""")
def upsert_products(r: Retail):
    """A catalog drawn from the order lines: several rows per product, the first wins."""
    lines = r.table("lineitem").join(r.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    catalog = lines.select(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.concat("p_name", F.lit(" v2")).alias("product_name"),
        F.when(F.col("l_linenumber") > 3, F.concat(F.lit("Line "), F.col("l_linenumber"))).alias("sub_category"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")
    order = F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")
    return wh.upsert_products(r.products(), catalog, order)


@query("wh_append_fact", """
SELECT 'orders_' || CAST(year(order_date) AS VARCHAR) || '.csv' AS source_file, count(*) AS n_rows,
  CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(min(date_key) AS INT) AS first_key, CAST(max(date_key) AS INT) AS last_key
FROM transactions GROUP BY 1
""")
def append_fact(r: Retail):
    """Load every file, load one of them again, and count what the fact then holds."""
    facts = r.transactions("order_id", "customer_id", "product_id", "order_date", "date_key", "quantity", "revenue")
    facts = facts.withColumn("source_file", F.concat(F.lit("orders_"), F.year("order_date").cast("string"), F.lit(".csv")))
    path = f"{shared_folder(r.spark)}/fact-{uuid4().hex}"
    wh.append_fact(facts, path)
    wh.append_fact(facts.filter(F.col("source_file") == "orders_1998.csv"), path)
    return r.spark.read.parquet(path).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("revenue").alias("revenue"),
        F.min("date_key").alias("first_key"), F.max("date_key").alias("last_key"))


@query("wh_evolve_fact_columns", """
SELECT order_id, line_number, date_key, CAST(revenue AS DOUBLE) AS revenue, CAST(NULL AS VARCHAR) AS category, brand FROM transactions
""")
def evolve_fact(r: Retail):
    older = r.transactions("order_id", "line_number", "date_key", "revenue", "brand")
    return wh.evolve_fact(older)


@query("wh_fk_violations", """
SELECT 'date_key' AS fk, CAST(date_key AS VARCHAR) AS key, count(*) AS n FROM transactions WHERE year(order_date) > 2000 GROUP BY 2
UNION ALL
SELECT 'customer_id', t.customer_id, count(*) FROM transactions t
WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = t.customer_id AND c.segment <> 'MACHINERY') GROUP BY 2
UNION ALL
SELECT 'product_id', t.product_id, count(*) FROM transactions t
WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = t.product_id) GROUP BY 2
""")
def fk_violations(r: Retail):
    facts = r.transactions("date_key", "customer_id", "product_id")
    calendar = wh.time_dimension(r.spark, r.span()[0], "2000-12-31")
    people = r.customers().filter(F.col("segment") != "MACHINERY")
    return wh.fk_violations(facts, calendar, people, r.products())


@query("wh_star_view", """
SELECT order_id, customer_id, product_id, strftime(date, '%Y-%m-%d') AS date, year, quarter, month,
  quantity, CAST(revenue AS DOUBLE) AS revenue, cat AS category, br AS brand, age_group, prime
FROM star
""")
def star_view(r: Retail):
    facts = r.transactions("order_id", "customer_id", "product_id", "order_date", "date_key", "quantity", "revenue",
                           "category", "brand", "is_prime_member")
    star = wh.star_view(facts, r.calendar(), r.products(), r.customers(), *r.span())
    return star.select("order_id", "customer_id", "product_id", F.date_format("date", "yyyy-MM-dd").alias("date"),
                       "year", "quarter", "month", "quantity", "revenue", "category", "brand", "age_group", "prime")
