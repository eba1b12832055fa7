"""Product, launch, rating, return, delivery and payment reports, and product pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.functions.numeric import half_even
from ledgerloom.operators.revenue import by_label, revenue_sum, share_of, top
from ledgerloom.operators.warehouse import in_range, label_products
from ledgerloom.session import cut_lineage, dealt


def portfolio_growth(products) -> DataFrame:
    return (products.filter(F.col("launch_year").isNotNull())
            .groupBy(F.col("launch_year").alias("year")).agg(F.count(F.lit(1)).alias("products")).orderBy("year"))


def measured(lines: DataFrame) -> DataFrame:
    """Columns whose plain sums give the average rating and the return rate."""
    rating = F.col("customer_rating").cast("decimal(5,2)")
    added = {}
    if "customer_rating" in lines.columns:
        added |= {"_rating": rating, "_rated": F.when(rating.isNotNull(), 1).otherwise(0)}
    if "is_returned" in lines.columns:
        added |= {"_returned": F.when(F.col("is_returned"), 1).otherwise(0), "_lines": F.lit(1)}
    return lines.withColumns(added)


def product_kpis(facts, calendar, products, start, end, n=20) -> DataFrame:
    sums = ["revenue", "quantity", "_rating", "_rated", "_returned", "_lines"]
    lines = measured(in_range(facts, calendar, start, end))
    small = lines.groupBy("product_id", "category").agg(*[F.sum(s).alias(s) for s in sums])
    named = label_products(small, products, "category", extra=["product_name"])
    totals = named.groupBy("product_id", F.coalesce("product_name", "product_id").alias("product_name"), "category").agg(
        *[F.sum(s).alias(s) for s in sums])
    return top(totals.select(
        "product_id", "product_name", "category", "revenue", F.col("quantity").cast("double").alias("units"),
        F.try_divide(F.col("_rating").cast("double"), F.col("_rated")).alias("avg_rating"),
        (F.col("_returned") / F.col("_lines")).alias("return_rate")), "revenue", "product_id", "category", n=n)


def demand_monthly(facts, calendar, start, end) -> DataFrame:
    units = in_range(facts, calendar, start, end, ["year", "month"]).groupBy("year", "month").agg(
        F.sum("quantity").cast("double").alias("units"))
    return units.withColumn("period", F.concat_ws("-", "year", "month")).orderBy("year", "month")


def rating_by_category(facts, calendar, products, start, end) -> DataFrame:
    rated = measured(facts.filter(F.col("customer_rating").isNotNull()))
    sums = by_label(rated, calendar, products, "category", start, end, sums=["_rating", "_rated"])
    return top(sums.select("category", (F.col("_rating").cast("double") / F.col("_rated")).alias("avg_rating"),
                           F.col("_rated").alias("cnt")), "avg_rating", "category")


def recent_launches(products, year: int, window: int = 3) -> DataFrame:
    return products.filter(F.col("launch_year") >= year - window).select(
        "product_id", "product_name", "brand", "category", "launch_year").orderBy(F.desc("launch_year"), "product_id")


def launch_adoption(facts, calendar, launches: DataFrame) -> DataFrame:
    """Monthly revenue of each launched product over the whole history.

    Summed per product and month first; the launch set then filters the small result.
    """
    months = in_range(facts, calendar, attrs=["year", "month"]).groupBy("product_id", "year", "month").agg(revenue_sum())
    return months.join(launches.select("product_id"), "product_id", "left_semi").withColumn(
        "period", F.concat_ws("-", "year", "month"))


def histogram(lines: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from the smallest to the largest value, the last one closed.

    Values are counted first, so the bin limits are found on distinct values only.
    """
    counts = lines.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("c"))
    limits = counts.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("x")).scalar()
    lo, hi = limits.getField("lo"), limits.getField("hi")
    slot = F.when(hi > lo, F.least(F.lit(bins), F.floor((F.col("v") - lo) * bins / (hi - lo)).cast("int") + 1)).otherwise(1)
    filled = counts.groupBy(slot.alias("bin")).agg(F.sum("c").alias("n"))
    width = (hi - lo) / bins
    every = lines.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return F.broadcast(every).join(filled, "bin", "left").select(
        "bin", (lo + width * (F.col("bin") - 1)).alias("low"), (lo + width * F.col("bin")).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n")).filter(lo.isNotNull())


def delivery_histogram(facts, calendar, start, end, bins=30) -> DataFrame:
    return histogram(in_range(facts, calendar, start, end), "delivery_days", bins)


def on_time_rate(facts, calendar, start, end, threshold=3) -> DataFrame:
    lines = in_range(facts.filter(F.col("delivery_days").isNotNull()), calendar, start, end)
    rate = F.sum(F.when(F.col("delivery_days") <= threshold, 1).otherwise(0)) / F.count(F.lit(1))
    return top(lines.groupBy("state", "city").agg(rate.alias("on_time")), "on_time", "state", "city")


def payment_share(facts, calendar, start, end) -> DataFrame:
    lines = in_range(facts.filter(F.col("payment_method").isNotNull()), calendar, start, end, ["year"])
    return lines.groupBy("year", "payment_method").agg(revenue_sum()).withColumn("share", share_of("revenue", "year"))


def return_rates(facts, calendar, products, start, end, n=50) -> DataFrame:
    sums = by_label(measured(facts), calendar, products, "category", start, end,
                    sums=["_returned", "_lines", "revenue", "quantity"])
    return top(sums.select("category", (F.col("_returned") / F.col("_lines")).alias("return_rate"), "revenue",
                           F.col("quantity").cast("double").alias("units")), "return_rate", "category", n=n)


def pairs_within(items: DataFrame, per_slice: int = 256) -> DataFrame:
    """Pairs a < b that share an order, counted; ``items`` has distinct (order_id, product_id).

    One side of an order is dealt to as many slices as it has ``per_slice`` products, the other side
    is copied to each of them, so no task holds a large order whole.
    """
    items = cut_lineage(items)
    rows = items.count()
    items = dealt(items, rows, "order_id")
    sizes = items.groupBy("order_id").agg(F.ceil(F.count(F.lit(1)) / per_slice).cast("int").alias("slices"))
    sliced = items.join(sizes, "order_id")
    left = sliced.select("order_id", F.col("product_id").alias("prod_a"),
                         F.pmod(F.xxhash64("product_id"), F.col("slices")).cast("int").alias("slice"))
    right = sliced.select("order_id", F.col("product_id").alias("prod_b"),
                          F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    left, right = (dealt(side, rows, "order_id", "slice") for side in (left, right))
    both = left.join(right, ["order_id", "slice"]).filter(F.col("prod_a") < F.col("prod_b"))
    return both.groupBy("prod_a", "prod_b").agg(F.count(F.lit(1)).alias("co_occurs"))


def product_pairs(facts, calendar, start, end, n=100, leading=400, per_slice=256) -> DataFrame:
    """The ``n`` product pairs bought together most often, exact.

    Pairs among the ``leading`` most frequent products are counted first. Their n-th count is a lower
    bound of the n-th best, and both products of a better pair are in at least as many orders: all
    rarer products drop out before the pairs of all orders are formed.
    """
    known = facts.filter(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
    items = cut_lineage(in_range(known, calendar, start, end).select("order_id", "product_id").distinct())
    support = cut_lineage(items.groupBy("product_id").agg(F.count(F.lit(1)).alias("orders")))
    ranked = [F.desc("co_occurs"), F.col("prod_a"), F.col("prod_b")]
    first = support.orderBy(F.desc("orders"), "product_id").limit(leading).select("product_id")
    sure = pairs_within(items.join(first, "product_id", "left_semi"), per_slice).orderBy(*ranked).limit(n)
    bound = sure.agg(F.when(F.count(F.lit(1)) == n, F.min("co_occurs"))).first()[0] or 1
    frequent = support.filter(F.col("orders") >= bound).select("product_id")
    return pairs_within(items.join(frequent, "product_id", "left_semi"), per_slice).orderBy(*ranked).limit(n)
