"""Exploratory tables over cleaned files, before any warehouse load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerloom.functions.dates import parse_date
from ledgerloom.functions.numeric import to_number
from ledgerloom.operators.customers import rfm_base, rfm_scored
from ledgerloom.operators.products import histogram
from ledgerloom.operators.revenue import column_names, month_matrix, revenue_sum, share_of, top, with_line
from ledgerloom.operators.warehouse import pick
from ledgerloom.presets import EXPLORE_COLUMNS, EXPLORE_DATE_FORMATS
from ledgerloom.session import cut_lineage


def coerce_date(c: Column) -> Column:
    """Explicit formats first, the general reading last."""
    return parse_date(c.cast("string"), EXPLORE_DATE_FORMATS, iso_first=False)


def explored(df: DataFrame, candidates: dict[str, list[str]] = EXPLORE_COLUMNS) -> DataFrame:
    """Logical columns that the files have, plus ``day``, ``year`` and ``month``."""
    names = {field: pick(df.columns, options) for field, options in candidates.items()}
    picked = df.select(*[F.col(f"`{n}`").alias(field) for field, n in names.items() if n])
    if "revenue" in picked.columns and isinstance(picked.schema["revenue"].dataType, T.StringType):
        picked = picked.withColumn("revenue", to_number(F.col("revenue")))
    if "order_date" in picked.columns:
        day = coerce_date(F.col("order_date"))
        picked = picked.withColumns({"day": day, "year": F.year(day), "month": F.month(day)})
    return picked


def yearly_trend(data: DataFrame, first: int = 2015, last: int = 2025) -> DataFrame:
    years = data.filter(F.col("year").between(first, last)).groupBy("year").agg(revenue_sum())
    now = F.col("revenue").cast("double")
    before = F.lag(now).over(Window.orderBy("year"))
    grown = years.withColumn("pct_growth", (F.try_divide(now, before) - 1) * 100)
    return with_line(grown, "year", 2)


def month_heatmap(data: DataFrame) -> DataFrame:
    dated = data.filter(F.col("day").isNotNull())
    return month_matrix(dated.groupBy("year", "month").agg(revenue_sum()))


def category_seasonality(data: DataFrame, categories: list[str]) -> DataFrame:
    """Month by category, 0 where nothing was sold; one column per category, in lower case."""
    cells = data.filter(F.col("month").isNotNull()).groupBy("month").pivot("category", categories).agg(F.sum("revenue"))
    return cells.select("month", *[
        F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(name) for c, name in column_names(categories).items()])


def rfm(data: DataFrame) -> DataFrame:
    whole = data.dropna(subset=["order_date", "revenue", "customer_id"])
    return rfm_scored(rfm_base(whole.select("customer_id", "day", "revenue")), segment=False)


def payment_share(data: DataFrame) -> DataFrame:
    known = data.filter(F.col("year").isNotNull() & F.col("payment_method").isNotNull())
    return known.groupBy("year", "payment_method").agg(revenue_sum()).withColumn("share", share_of("revenue", "year"))


def payment_share_matrix(shares: DataFrame, methods: list[str] | None = None) -> DataFrame:
    """Year by method; columns s0.. follow the order of ``methods``, by default all there are, by name.

    The shares have a row per year and method; they are written, and the names read from there.
    """
    if methods is None:
        shares = cut_lineage(shares)
        methods = sorted(r[0] for r in shares.select("payment_method").distinct().collect())
    cells = shares.groupBy("year").pivot("payment_method", methods).agg(F.max("share"))
    return cells.select("year", *[F.coalesce(F.col(f"`{m}`"), F.lit(0.0)).alias(f"s{i}") for i, m in enumerate(methods)])


def category_latest_year(data: DataFrame) -> DataFrame:
    known = data.filter(F.col("year").isNotNull() & F.col("category").isNotNull())
    totals = known.groupBy("year", "category").agg(revenue_sum())
    newest = known.agg(F.max("year")).scalar()
    return top(totals.filter(F.col("year") == newest), "revenue", "category")


def prime_aov(data: DataFrame) -> DataFrame:
    known = data.filter(F.col("is_prime_member").isNotNull())
    mean = F.try_divide(F.sum("revenue").cast("double"), F.count("revenue"))
    return known.groupBy(F.col("is_prime_member").alias("prime")).agg(mean.alias("revenue"))


def prime_order_frequency(data: DataFrame) -> DataFrame:
    """Average number of rows per customer and membership."""
    known = data.filter(F.col("is_prime_member").isNotNull() & F.col("customer_id").isNotNull())
    orders = known.groupBy("customer_id", F.col("is_prime_member").alias("prime")).agg(F.count(F.lit(1)).alias("orders"))
    return orders.groupBy("prime").agg((F.sum("orders") / F.count(F.lit(1))).alias("orders"))


def top_cities(data: DataFrame, n: int = 20) -> DataFrame:
    return top(data.filter(F.col("city").isNotNull()).groupBy("city").agg(revenue_sum()), "revenue", "city", n=n)


def price_quantity_corr(data: DataFrame) -> DataFrame:
    """Pearson correlations in long form; the price is the unit price where there is one."""
    price = "unit_price" if "unit_price" in data.columns else "revenue"
    names = [price, "quantity"]
    pairs = [(a, b) for a in names for b in names]
    row = data.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"_{i}").alias("corr")) for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(cells).alias("c")).select("c.*")


def delivery_distribution(data: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(data, "delivery_days", bins)


def delivery_vs_rating(data: DataFrame) -> DataFrame:
    both = data.filter(F.col("delivery_days").isNotNull() & F.col("customer_rating").isNotNull())
    return both.groupBy("delivery_days", "customer_rating").agg(F.count(F.lit(1)).alias("n"))
