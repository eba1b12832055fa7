"""Query registry and the SQL views every check starts from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions.numeric import at_edge
from ledgerloom.sources.retail import Retail

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VIEWS = """
WITH base AS (
  SELECT *, l_orderkey * 7 + l_partkey + l_linenumber AS k, CAST(o_orderdate AS DATE) AS od
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey
), transactions AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(c_custkey AS VARCHAR) AS customer_id,
    CAST(l_partkey AS VARCHAR) AS product_id, od AS order_date,
    CAST(year(od) * 10000 + month(od) * 100 + day(od) AS INT) AS date_key,
    l_quantity AS quantity, l_extendedprice AS list_price, l_extendedprice / l_quantity AS unit_price,
    CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS revenue,
    CAST(round(l_discount * 100) AS DOUBLE) AS discount_pct,
    CASE WHEN k % 11 <> 0 THEN p_type END AS category, p_brand AS brand, o_orderpriority AS payment_method,
    n_name AS city, CASE WHEN k % 13 <> 0 THEN r_name END AS state,
    CASE WHEN c_custkey % 10 <> 7 THEN c_custkey % 3 = 0 END AS is_prime_member,
    CAST(CASE WHEN k % 17 <> 0 THEN (date_diff('day', od, CAST(l_shipdate AS DATE)) % 46 + 46) % 46 END AS INT) AS delivery_days,
    CASE WHEN k % 5 <> 0 THEN CAST(10 + k % 41 AS DOUBLE) / 10 END AS customer_rating,
    l_returnflag = 'R' AS is_returned, k, l_linenumber AS line_number,
    row_number() OVER (ORDER BY od, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS tx_id
  FROM base
), products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
    CASE WHEN p_partkey % 8 <> 0 THEN p_brand END AS brand, CASE WHEN p_partkey % 9 <> 0 THEN p_type END AS category,
    CAST(1995 + p_partkey % 7 AS INT) AS launch_year, CAST(p_retailprice AS DECIMAL(18,2)) AS base_price_2015
  FROM part WHERE p_partkey % 20 <> 0
), customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
    CASE c_custkey % 6 WHEN 0 THEN '18-25' WHEN 1 THEN '26-35' WHEN 2 THEN '36-45' WHEN 3 THEN '46-55' WHEN 4 THEN '56+' END AS age_group,
    n_name AS city, r_name AS state, c_custkey % 4 = 0 AS is_prime_member, c_mktsegment AS segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), time_dimension AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INT) AS date_key, CAST(d AS DATE) AS date,
    CAST(day(d) AS INT) AS day, CAST(month(d) AS INT) AS month, CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year
  FROM generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY) AS s(d)
), star AS (
  SELECT t.order_id, t.customer_id, t.product_id, t.quantity, t.unit_price, t.revenue, t.discount_pct, t.payment_method,
    t.city, t.state, t.delivery_days, t.customer_rating, t.is_returned, t.tx_id, d.date, d.year, d.quarter, d.month,
    coalesce(p.category, t.category, 'Unknown') AS cat, coalesce(p.brand, t.brand, 'Unknown') AS br,
    p.category AS p_category, p.brand AS p_brand_only, p.product_name, c.age_group,
    coalesce(t.is_prime_member, c.is_prime_member) AS prime
  FROM transactions t JOIN time_dimension d ON d.date_key = t.date_key
  LEFT JOIN products p ON p.product_id = t.product_id LEFT JOIN customers c ON c.customer_id = t.customer_id
)"""

RAW_VIEW = """, raw AS (
  SELECT order_id, CAST(line_number AS VARCHAR) AS line_number, customer_id, product_id,
    CAST(CAST(quantity AS INT) AS VARCHAR) AS quantity, tx_id,
    CASE k % 6 WHEN 1 THEN strftime(order_date, '%d/%m/%Y') WHEN 2 THEN strftime(order_date, '%d-%m-%y')
      WHEN 3 THEN 'not-a-date' WHEN 4 THEN NULL ELSE strftime(order_date, '%Y-%m-%d') END AS order_date,
    CASE k % 7 WHEN 0 THEN '₹ ' || CAST(list_price AS VARCHAR) WHEN 1 THEN '(' || CAST(list_price AS VARCHAR) || ')'
      WHEN 2 THEN 'N/A' WHEN 3 THEN 'Rs. ' || CAST(list_price AS VARCHAR) WHEN 4 THEN NULL
      WHEN 5 THEN CAST(CAST(floor(list_price) AS BIGINT) AS VARCHAR) || '00' ELSE CAST(list_price AS VARCHAR) END AS price,
    CASE k % 6 WHEN 0 THEN '4 stars' WHEN 1 THEN '3/5' WHEN 2 THEN '4.5' WHEN 3 THEN 'bad' WHEN 5 THEN '9/10' END AS rating,
    CASE k % 7 WHEN 0 THEN 'Bangalore' WHEN 1 THEN 'bengaluru ' WHEN 2 THEN 'Hydrabad' WHEN 3 THEN 'New Delhi'
      WHEN 4 THEN 'Nowhere' WHEN 6 THEN 'MUMBAI' END AS city,
    CASE k % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'n' WHEN 2 THEN 'TRUE' WHEN 3 THEN '0' WHEN 4 THEN 'maybe' END AS prime,
    CASE k % 7 WHEN 0 THEN 'Same Day' WHEN 1 THEN '2-4 days' WHEN 2 THEN '5' WHEN 3 THEN '90 days' WHEN 4 THEN '-3'
      WHEN 6 THEN 'Express' END AS delivery,
    CASE k % 8 WHEN 0 THEN 'PhonePe' WHEN 1 THEN 'C.O.D' WHEN 2 THEN 'CREDIT_CARD' WHEN 3 THEN 'debit card'
      WHEN 4 THEN 'NetBanking' WHEN 5 THEN 'Store wallet' WHEN 7 THEN 'Bank Account' END AS payment,
    CASE k % 4 WHEN 0 THEN ' Electronics & Accessories ' WHEN 1 THEN 'ELECTRONIC' WHEN 2 THEN 'Home   Decor' END AS category
  FROM transactions
)"""


def query(key: str, sql: str | None = None, raw: bool = False):
    """Register ``plan(retail) -> DataFrame`` under ``key``.

    ``sql`` continues the common WITH list: it starts with SELECT or with ``, name AS (``.
    """

    def add(plan: Callable[[Retail], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: at_edge(plan(Retail(spark, sf_dir)))
        if sql is not None:
            ORACLES[key] = VIEWS + (RAW_VIEW if raw else "") + "\n" + sql.strip()
        return plan

    return add
