"""Cleaning steps, the whole cleaning run, file scans and outputs."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.config import CleaningConfig, Dedup, Delivery, Geo, Missing, Outliers, Payment, Price, Ratings
from ledgerloom.config import Booleans, Categorical, Dates
from ledgerloom.functions.numeric import half_even
from ledgerloom.operators import cleaning as cl
from ledgerloom.plans import jobs
from ledgerloom.plans.registry import query
from ledgerloom.session import shared_folder
from ledgerloom.sources import files
from ledgerloom.sources.retail import Retail

KEYS = ("order_id", "line_number")
RAW_TEXT = ["order_date", "price", "rating", "city", "prime", "delivery", "payment", "category"]

DATES = Dates(fields=("order_date",), input_formats=tuple(presets.TRANSACTION_DATE_FORMATS), invalid_to_null=True)
GEO = Geo("city", tuple(presets.CANONICAL_CITIES), presets.CITY_MAPPINGS, presets.CITY_CUTOFF)
CATEGORIES = Categorical(fields=("category",), mappings={"category": presets.CATEGORY_MAPPINGS})

RUN = CleaningConfig(
    dates=DATES, price=Price(fields=("price",), coerce_invalid_to_null=True), ratings=Ratings("rating"),
    categorical=CATEGORIES, geo=GEO, booleans=Booleans(("prime",)), delivery=Delivery("delivery"),
    dedup=Dedup(("order_id", "line_number", "not_there")), outliers=Outliers("price", high_factor=5.0),
    payment=Payment("payment", presets.PAYMENT_MAPPINGS))


def in_sql(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


# SQL of the single rules, written independently of the Spark expressions
def sql_date(c: str) -> str:
    return (f"CASE WHEN regexp_full_match({c}, '[0-9]{{4}}-.*') THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE) "
            f"ELSE coalesce(CAST(try_strptime({c}, '%d/%m/%Y') AS DATE), CAST(try_strptime({c}, '%d-%m-%y') AS DATE)) END")


def sql_price(c: str) -> str:
    kept = f"replace(regexp_replace({c}, '[^0-9.,()-]', '', 'g'), ',', '')"
    return f"round_even(try_cast(regexp_replace({kept}, '^\\((.*)\\)$', '-\\1') AS DOUBLE) * 100, 0) / 100"


def sql_rating(c: str) -> str:
    value = (f"CASE WHEN try_cast({c} AS DOUBLE) > 0 THEN try_cast({c} AS DOUBLE) "
             f"WHEN regexp_full_match({c}, '[0-9.]+ *stars?') THEN CAST(regexp_extract({c}, '[0-9.]+') AS DOUBLE) "
             f"WHEN regexp_full_match({c}, '[0-9.]+/[0-9.]+') THEN CAST(split_part({c}, '/', 1) AS DOUBLE) / CAST(split_part({c}, '/', 2) AS DOUBLE) * 5 END")
    return f"CASE WHEN ({value}) IS NOT NULL THEN least(5, greatest(1, {value})) END"


def sql_category(c: str) -> str:
    tidy = f"regexp_replace(replace(lower(trim({c})), '&', 'and'), ' +', ' ', 'g')"
    return f"CASE WHEN {tidy} IN ('electronic', 'electronics', 'electronic accessories') THEN 'electronics' ELSE {tidy} END"


# Hydrabad is the one spelling here that only the close match resolves
def sql_city(c: str) -> str:
    return (f"CASE WHEN {c} IN ('Bangalore') OR lower(trim({c})) = 'bengaluru' THEN 'Bengaluru' WHEN {c} = 'New Delhi' THEN 'Delhi' "
            f"WHEN lower({c}) = 'mumbai' THEN 'Mumbai' WHEN {c} = 'Hydrabad' THEN 'Hyderabad' ELSE {c} END")


def sql_bool(c: str) -> str:
    return (f"CASE WHEN lower(trim({c})) IN ('true', 't', 'yes', 'y', '1') THEN true "
            f"WHEN lower(trim({c})) IN ('false', 'f', 'no', 'n', '0') THEN false END")


def sql_delivery(c: str) -> str:
    return (f"CAST(CASE WHEN lower({c}) = 'same day' THEN 0 WHEN regexp_matches({c}, '^[0-9]+-[0-9]+') "
            f"THEN least(30, greatest(CAST(regexp_extract({c}, '^([0-9]+)-', 1) AS INT), CAST(regexp_extract({c}, '^[0-9]+-([0-9]+)', 1) AS INT))) "
            f"WHEN regexp_matches({c}, '^[0-9]+') THEN least(30, CAST(regexp_extract({c}, '^[0-9]+') AS INT)) END AS INT)")


def sql_payment(c: str) -> str:
    return (f"CASE {c} WHEN 'PhonePe' THEN 'UPI' WHEN 'C.O.D' THEN 'Cash on Delivery' WHEN 'CREDIT_CARD' THEN 'Credit Card' "
            f"WHEN 'debit card' THEN 'Debit Card' WHEN 'NetBanking' THEN 'Net Banking' WHEN 'Store wallet' THEN 'Wallet' "
            f"WHEN 'Bank Account' THEN 'Credit Card' END")


def sql_mode(c: str) -> str:
    return f"(SELECT {c} FROM raw WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1)"


@query("cln_impute_numeric", """
SELECT order_id, line_number, quantity,
  coalesce(customer_rating, round_even((SELECT quantile_cont(customer_rating, 0.5) FROM transactions) * 1e6, 0) / 1e6) AS customer_rating,
  coalesce(CAST(delivery_days AS DOUBLE), (SELECT quantile_cont(CAST(delivery_days AS DOUBLE), 0.5) FROM transactions)) AS delivery_days
FROM transactions
""")
def impute_numeric(r: Retail):
    df, _ = cl.copied(r.transactions(*KEYS, "quantity", "customer_rating", "delivery_days"), [])
    done = cl.impute_numeric(df, ["quantity", "customer_rating", "delivery_days"])
    return done.drop("_place").withColumn("customer_rating", half_even(F.col("customer_rating"), 6))


@query("cln_impute_mode", f"""
SELECT order_id, line_number, {", ".join(f"coalesce({c}, {sql_mode(c)}) AS {c}" for c in RAW_TEXT)} FROM raw
""", raw=True)
def impute_mode(r: Retail):
    return cl.impute_missing(r.raw(*KEYS, *RAW_TEXT), Missing(exclude=KEYS))


@query("cln_dates", f"SELECT order_id, line_number, strftime({sql_date('order_date')}, '%Y-%m-%d') AS order_date FROM raw", raw=True)
def dates(r: Retail):
    return cl.clean_one(cl.dates_step, r.raw(*KEYS, "order_date"), DATES)


#: a line's order day in a notation that its line number chooses
NOTATIONS = """case line_number % 7 when 0 then date_format(order_date, 'yyyy/MM/dd') when 1 then date_format(order_date, 'MMM d, yyyy')
    when 2 then date_format(order_date, 'd MMMM yyyy') when 3 then date_format(order_date, 'MM/dd/yyyy')
    when 4 then date_format(order_date, 'yyyyMMdd') when 5 then date_format(order_date, 'd-MMM-yy') else date_format(order_date, 'yyyy-MM-dd 10:20:30') end"""
#: of two numbers up to 12 the general reading cannot tell the month; the day itself otherwise
READ_BACK = """SELECT order_id, line_number, strftime(CASE WHEN line_number % 7 = 3 AND day(order_date) <= 12 AND day(order_date) <> month(order_date)
    THEN {otherwise} ELSE order_date END, '%Y-%m-%d') AS order_date FROM transactions"""


@query("cln_dates_general", READ_BACK.format(otherwise="NULL"))
def dates_general(r: Retail):
    rows = r.transactions(*KEYS, "order_date").withColumn("order_date", F.expr(NOTATIONS))
    return cl.clean_one(cl.dates_step, rows, Dates(fields=("order_date",), input_formats=(), invalid_to_null=True))


@query("cln_prices", f"""
SELECT order_id, line_number, {sql_price('price')} AS price, CASE WHEN {sql_price('price')} IS NULL THEN price END AS price_raw FROM raw
""", raw=True)
def prices(r: Retail):
    return cl.clean_one(cl.prices_step, r.raw(*KEYS, "price"), Price(fields=("price",)))


@query("cln_ratings", f"""
, p AS (SELECT order_id, line_number, {sql_rating('rating')} AS x FROM raw)
SELECT order_id, line_number, round_even(coalesce(x, (SELECT quantile_cont(x, 0.5) FROM p)) * 10, 0) / 10 AS rating FROM p
""", raw=True)
def ratings(r: Retail):
    return cl.clean_one(cl.ratings_step, r.raw(*KEYS, "rating"), Ratings("rating"), ())


@query("cln_categories", f"SELECT order_id, line_number, {sql_category('category')} AS category FROM raw", raw=True)
def categories(r: Retail):
    return cl.clean_one(cl.categories_step, r.raw(*KEYS, "category"), CATEGORIES)


@query("cln_cities", f"SELECT order_id, line_number, {sql_city('city')} AS city FROM raw", raw=True)
def cities(r: Retail):
    return cl.clean_one(cl.cities_step, r.raw(*KEYS, "city"), GEO)


@query("cln_booleans", f"SELECT order_id, line_number, {sql_bool('prime')} AS prime FROM raw", raw=True)
def booleans(r: Retail):
    return cl.clean_one(cl.booleans_step, r.raw(*KEYS, "prime"), Booleans(("prime",)))


@query("cln_delivery", f"SELECT order_id, line_number, {sql_delivery('delivery')} AS delivery FROM raw", raw=True)
def delivery(r: Retail):
    return cl.clean_one(cl.delivery_step, r.raw(*KEYS, "delivery"), Delivery("delivery"))


@query("cln_dedup_keep_first", """
SELECT order_id, line_number, product_id, quantity, price, city FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, line_number ORDER BY tx_id) AS rn FROM raw) WHERE rn = 1
""", raw=True)
def dedup_keep_first(r: Retail):
    df = r.raw(*KEYS, "product_id", "quantity", "price", "city", "tx_id")
    return cl.deduplicate(df, Dedup(KEYS), F.col("tx_id")).drop("tx_id")


@query("cln_dedup_aggregate", """
SELECT order_id, line_number, sum(CAST(quantity AS DOUBLE)) AS quantity, arg_min(price, tx_id) FILTER (price IS NOT NULL) AS price,
  arg_min(city, tx_id) FILTER (city IS NOT NULL) AS city FROM raw GROUP BY 1, 2
""", raw=True)
def dedup_aggregate(r: Retail):
    df = r.raw(*KEYS, "quantity", "price", "city", "tx_id")
    return cl.deduplicate(df, Dedup(KEYS, "quantity", "aggregate"), F.col("tx_id")).drop("tx_id")


SQL_OUTLIERS = """CASE WHEN x > m * 5 AND x / 10 BETWEEN m / 10 AND m * 10 THEN x / 10
    WHEN x > m * 5 AND x / 100 BETWEEN m / 10 AND m * 10 THEN x / 100 ELSE x END"""


@query("cln_outliers", f"""
, p AS (SELECT order_id, line_number, try_cast(price AS DOUBLE) AS x FROM raw),
s AS (SELECT quantile_cont(x, 0.5) AS m FROM p)
SELECT order_id, line_number, round_even(({SQL_OUTLIERS}) * 100, 0) / 100 AS price FROM p, s
""", raw=True)
def outliers(r: Retail):
    return cl.clean_one(cl.outliers_step, r.raw(*KEYS, "price"), Outliers("price", high_factor=5.0), ())


@query("cln_payment", f"SELECT order_id, line_number, {sql_payment('payment')} AS payment FROM raw", raw=True)
def payment(r: Retail):
    return cl.clean_one(cl.payment_step, r.raw(*KEYS, "payment"), Payment("payment", presets.PAYMENT_MAPPINGS))


CLEAN_SQL = f"""
, filled AS (SELECT order_id, line_number, product_id, quantity, tx_id, {", ".join(f"coalesce({c}, {sql_mode(c)}) AS {c}" for c in RAW_TEXT)} FROM raw),
parsed AS (SELECT order_id, line_number, product_id, quantity, tx_id, {sql_date('order_date')} AS d, {sql_price('price')} AS x, {sql_rating('rating')} AS rt,
  {sql_category('category')} AS category, {sql_city('city')} AS city, {sql_bool('prime')} AS prime, {sql_delivery('delivery')} AS delivery,
  payment, city AS old_city, category AS old_category FROM filled),
rated AS (SELECT * REPLACE (round_even(coalesce(rt, (SELECT quantile_cont(rt, 0.5) FROM parsed)) * 10, 0) / 10 AS rt), rt IS NOT NULL AS read FROM parsed),
single AS (SELECT *, row_number() OVER (PARTITION BY order_id, line_number ORDER BY tx_id) AS rn FROM rated),
s AS (SELECT quantile_cont(x, 0.5) AS m FROM single WHERE rn = 1),
cleaned AS (SELECT order_id, line_number, product_id, quantity, strftime(d, '%Y-%m-%d') AS order_date,
  round_even(({SQL_OUTLIERS}) * 100, 0) / 100 AS price, rt AS rating, category, city, prime, delivery, {sql_payment('payment')} AS payment,
  coalesce(x > m * 5, false) AS high, x, m FROM single, s WHERE rn = 1)
"""


@query("cln_run_all", CLEAN_SQL + """
SELECT order_id, line_number, product_id, quantity, order_date, price, rating, category, city, prime, delivery, payment FROM cleaned
""", raw=True)
def run_all(r: Retail):
    df = r.raw(*KEYS, "product_id", "quantity", *RAW_TEXT, "tx_id").withColumnRenamed("tx_id", "_tx")
    cleaned, _ = cl.run_cleaning(df, RUN, F.col("_tx"), report=False)
    return cleaned


NAMES = ["order_id", "line_number", "product_id", "quantity", *RAW_TEXT]
BEFORE = " UNION ALL ".join(
    f"SELECT 'dq' AS step, '{c}' AS field, 'missing_before' AS metric, CAST(count(*) - count({c}) AS DOUBLE) AS value FROM raw "
    f"UNION ALL SELECT 'dq', '{c}', 'missing_after', CAST(count(*) - count({c}) AS DOUBLE) FROM cleaned "
    f"UNION ALL SELECT 'missing', '{c}', 'imputed', CAST(count(*) - count({c}) AS DOUBLE) FROM raw" for c in NAMES)


REPORT_SQL = BEFORE + """
UNION ALL SELECT 'dq', '', 'rows_before', CAST(count(*) AS DOUBLE) FROM raw
UNION ALL SELECT 'dq', '', 'rows_after', CAST(count(*) AS DOUBLE) FROM cleaned
UNION ALL SELECT 'dates', 'order_date', 'converted', CAST(count(d) AS DOUBLE) FROM parsed
UNION ALL SELECT 'price', 'price', 'standardized', CAST(count(x) AS DOUBLE) FROM parsed
UNION ALL SELECT 'ratings', 'rating', 'changed', CAST(count(*) FILTER (read) AS DOUBLE) FROM rated
UNION ALL SELECT 'ratings', 'rating', 'imputed', CAST(count(*) FILTER (rating IS NULL) AS DOUBLE) FROM filled
UNION ALL SELECT 'categorical', 'category', 'standardized', CAST(count(*) FILTER (category IS DISTINCT FROM old_category) AS DOUBLE) FROM parsed
UNION ALL SELECT 'geo', 'city', 'resolved', CAST(count(*) FILTER (old_city <> 'Nowhere') AS DOUBLE) FROM parsed
UNION ALL SELECT 'booleans', 'prime', 'standardized', CAST(count(prime) AS DOUBLE) FROM filled
UNION ALL SELECT 'delivery', 'delivery', 'changed', CAST(count(delivery) AS DOUBLE) FROM filled
UNION ALL SELECT 'delivery', 'delivery', 'nullified', CAST(count(*) - count(delivery) AS DOUBLE) FROM parsed
UNION ALL SELECT 'dedup', '', 'dropped', CAST(count(*) FILTER (rn > 1) AS DOUBLE) FROM single
UNION ALL SELECT 'dedup', '', 'kept', CAST(count(*) FILTER (rn = 1) AS DOUBLE) FROM single
UNION ALL SELECT 'dedup', 'not_there', 'missing_key', 1.0
UNION ALL SELECT 'outliers', 'price', 'corrected', CAST(count(*) FILTER (price IS DISTINCT FROM x) AS DOUBLE) FROM cleaned
UNION ALL SELECT 'outliers', 'price', 'flagged', CAST(count(*) FILTER (high AND price = x) AS DOUBLE) FROM cleaned
UNION ALL SELECT 'outliers', 'price', 'median', max(m) FROM s
UNION ALL SELECT 'payment', 'payment', 'standardized', CAST(count(*) FILTER (payment IS NOT NULL) AS DOUBLE) FROM cleaned
"""


@query("cln_quality_report", CLEAN_SQL + REPORT_SQL, raw=True)
def quality_report(r: Retail):
    df = r.raw(*KEYS, "product_id", "quantity", *RAW_TEXT, "tx_id").withColumnRenamed("tx_id", "_tx")
    return cl.run_cleaning(df, RUN, F.col("_tx"))[1]


# --- files: the raw rows are written as CSV by Spark and read back -----------

CSV_COLUMNS = ["order_id", "line_number", "order_date", "price", "city", "category"]


def csv_folder(r: Retail) -> str:
    return f"{shared_folder(r.spark)}/csv-{uuid4().hex}"


def in_row_order(r: Retail, *columns: str):
    """Raw rows sorted, so that the order of the written files is the order of the rows."""
    return r.raw(*columns, sort=True)


@query("src_csv_scan", """
SELECT CAST(order_id AS BIGINT) AS order_id, CAST(line_number AS BIGINT) AS line_number, order_date,
  CASE WHEN price <> 'N/A' THEN price END AS price, CAST(list_price AS DOUBLE) AS list_price, strftime(paid_on, '%Y-%m-%d') AS paid_on,
  city, category, 'lines.csv' AS source_file
FROM raw JOIN (SELECT tx_id, list_price, order_date AS paid_on FROM transactions) USING (tx_id)
""", raw=True)
def csv_scan(r: Retail):
    """Types as the values have them: whole numbers, numbers, days, and text."""
    path = f"{csv_folder(r)}/lines.csv"
    rows = r.raw(*CSV_COLUMNS, "tx_id").withColumns({
        "list_price": F.col("tx_id.tx_id.l_extendedprice"), "paid_on": F.col("tx_id.order_day")}).drop("tx_id")
    files.csv_writer(rows).csv(path)
    typed, = files.scan_groups(r.spark, [path], types=True)
    assert dict(typed.dtypes)["list_price"] == "double" and dict(typed.dtypes)["paid_on"] == "date"
    return typed.select(*CSV_COLUMNS, "list_price", F.date_format("paid_on", "yyyy-MM-dd").alias("paid_on"), "source_file")


@query("src_multi_file_union", """
SELECT order_id, line_number, CASE WHEN price <> 'N/A' THEN price END AS price,
  CASE WHEN CAST(line_number AS INT) > 3 THEN city END AS city, CASE WHEN CAST(line_number AS INT) <= 3 THEN category END AS category,
  CASE WHEN CAST(line_number AS INT) <= 3 THEN 'first lines.csv' ELSE 'Later.CSV' END AS source_file FROM raw
""", raw=True)
def multi_file_union(r: Retail):
    """Two files whose columns differ."""
    folder, rows = csv_folder(r), r.raw(*CSV_COLUMNS)
    early = F.col("line_number").cast("int") <= 3
    files.csv_writer(rows.filter(early).drop("city")).csv(f"{folder}/first lines.csv")
    files.csv_writer(rows.filter(~early).drop("category")).csv(f"{folder}/Later.CSV")
    return files.scan_folder(r.spark, folder).select("order_id", "line_number", "price", "city", "category", "source_file")


@query("src_route_by_config", """
SELECT 'Product_Catalog.csv' AS source_file, 'catalog' AS config, count(*) AS n_rows FROM products
UNION ALL SELECT 'orders_b.csv', 'transactions', count(*) FROM raw WHERE CAST(line_number AS INT) > 3
""", raw=True)
def route_by_config(r: Retail):
    """Rows per file and configuration, with one of three files already done."""
    folder, out = csv_folder(r), csv_folder(r)
    rows = r.raw(*KEYS, "customer_id", "product_id", "order_date", "price")
    early = F.col("line_number").cast("int") <= 3
    for name, part in (("Product_Catalog", r.products()), ("orders_a", rows.filter(early)), ("orders_b", rows.filter(~early))):
        files.csv_writer(part).csv(f"{folder}/{name}.csv")
    done = files.list_csv(r.spark, folder).filter(F.col("name") == "orders_a.csv").select(F.col("name").alias("file")).distinct()
    done.write.json(f"{out}/report")
    routed = files.route_files(r.spark, folder, out)
    whole = files.scan_files(r.spark, [row.path for row in routed.collect()])
    plan = routed.select(F.col("name").alias("source_file"), "config").distinct()
    counts = whole.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(plan, "source_file").select("source_file", "config", "n_rows")


SCANNED = ", scanned AS (SELECT * REPLACE (CASE WHEN price <> 'N/A' THEN price END AS price) FROM raw)"


@query("snk_clean_output", SCANNED + (CLEAN_SQL + REPORT_SQL).replace("FROM raw", "FROM scanned"), raw=True)
def clean_output(r: Retail):
    """Clean a folder file by file and return the report as written."""
    folder, out = csv_folder(r), csv_folder(r)
    files.csv_writer(in_row_order(r, *NAMES)).csv(f"{folder}/dirty.csv")
    report = jobs.clean_folder(r.spark, folder, out, configs={"transactions": RUN})
    return report.select("step", F.coalesce("field", F.lit("")).alias("field"), "metric", "value")
