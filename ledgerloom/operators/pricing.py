"""Price, demand and discount reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.order_stats import quantiles_of_counts, same_key
from ledgerloom.operators.revenue import by_label, only_product_categories
from ledgerloom.operators.warehouse import in_range, label_products
from ledgerloom.session import cut_lineage

LOG_SHIFT = 1e-6  # fixed value: added before taking logarithms


def price_demand(facts, calendar, products, start, end, categories=None, brands=None) -> DataFrame:
    """(category, brand, unit_price, quantity) of every line that has both numbers."""
    lines = in_range(facts, calendar, start, end).filter(
        F.col("unit_price").isNotNull() & F.col("quantity").isNotNull())
    rows = label_products(lines, products, "category", "brand")
    for label, chosen in (("category", categories), ("brand", brands)):
        if chosen:
            rows = rows.filter(F.col(label).isin(list(chosen)))
    return rows.select("category", "brand", "unit_price", "quantity")


def price_demand_fit(rows: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    """Line of quantity on price per group."""
    y, x = F.col("quantity").cast("double"), F.col("unit_price").cast("double")
    return rows.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.count(F.lit(1)).alias("n"))


def elasticity(rows: DataFrame, keys: Sequence[str] = ("category",), min_obs: int = 30) -> DataFrame:
    """Log-log slope of quantity on price and its R2, for groups with enough rows."""
    y = F.log(F.col("quantity").cast("double") + LOG_SHIFT)
    x = F.log(F.col("unit_price").cast("double") + LOG_SHIFT)
    fits = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("elasticity"),
        F.regr_r2(y, x).alias("_r2"), F.var_pop(y).alias("_spread"))
    return fits.filter(F.col("n") >= min_obs).select(
        *keys, "n", "elasticity", F.when(F.col("_spread") > 0, F.col("_r2")).alias("r2"))


def discount_bucket(top: float, buckets: int) -> Column:
    given = F.coalesce(F.col("discount_pct").cast("double"), F.lit(0.0))
    return F.width_bucket(given, F.lit(0.0), F.lit(float(top)), F.lit(buckets)).cast("int")


def discount_effect(facts, calendar, products, start, end, top=50, buckets=6, categories=None) -> DataFrame:
    """Average discount, units and revenue per category and discount bucket; bucket 0 is
    below zero, ``buckets + 1`` is at or above ``top``. Empty when either is not positive."""
    usable = top > 0 and buckets > 0
    lines = only_product_categories(facts, products, categories)
    discount = F.col("discount_pct").cast("decimal(9,4)")
    lines = lines.withColumns({
        "disc_bucket": discount_bucket(top, buckets) if usable else F.lit(0),
        "_d": discount, "_n": F.when(discount.isNotNull(), 1).otherwise(0)})
    sums = by_label(lines if usable else lines.limit(0), calendar, products, "category", start, end,
                    sums=["_d", "_n", "quantity", "revenue"], more=["disc_bucket"])
    label = F.col("disc_bucket") * (F.lit(float(top)) / F.lit(float(buckets or 1)))
    return sums.select(
        "category", "disc_bucket", label.alias("disc_label"),
        F.try_divide(F.col("_d").cast("double"), F.col("_n")).alias("avg_disc"),
        F.col("quantity").cast("double").alias("units"), "revenue")


def discount_matrix(effect: DataFrame, buckets: int) -> DataFrame:
    """Category by discount bucket revenue, 0 where nothing was sold; columns b0..b(n+1)."""
    slots = list(range(0, buckets + 2))
    cells = effect.groupBy("category").pivot("disc_bucket", slots).agg(F.sum("revenue"))
    return cells.select("category", *[F.coalesce(F.col(str(s)).cast("double"), F.lit(0.0)).alias(f"b{s}") for s in slots])


def price_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, units and price x quantity per group and distinct price."""
    price, units = F.col("unit_price").cast("double"), F.col("quantity").cast("double")
    counted = rows.groupBy(*keys, price.alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"), F.sum(units).alias("units"), F.sum(price * units).alias("line_revenue"))
    return cut_lineage(counted)


def price_bands(rows: DataFrame, min_obs: int = 30, bands: int = 10) -> DataFrame:
    """Units and revenue per price band of each category with enough rows.

    Band edges are interpolated quantiles without repeats; bands are closed on the right,
    the first also holds the lowest price.
    """
    counts = price_counts(rows, ["category"])
    probs = [i * (1.0 / bands) for i in range(bands)] + [1.0]
    edges = quantiles_of_counts(counts.select("category", "_v", "_c"), ["category"], probs, "edges")
    edges = edges.filter(F.col("n") >= min_obs).withColumn("edges", F.array_distinct("edges"))
    inner = F.slice("edges", F.lit(2), F.greatest(F.size("edges") - 2, F.lit(0)))
    placed = counts.alias("h").join(edges.alias("e"), same_key("h", "e", ["category"])).select("h.*", "e.edges")
    placed = placed.withColumn("band", F.size(F.filter(inner, lambda e: e < F.col("_v"))) + 1)
    return placed.groupBy("category", "band").agg(
        F.max(F.element_at("edges", F.col("band"))).alias("low"),
        F.max(F.try_element_at("edges", F.col("band") + 1)).alias("high"),
        F.sum("units").alias("units"), F.sum("line_revenue").alias("revenue"))


def price_positions(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Median price and units per group."""
    counts = price_counts(rows, keys)
    middle = quantiles_of_counts(counts.select(*keys, "_v", "_c"), keys, [0.5], "_q")
    units = counts.groupBy(*keys).agg(F.sum("units").alias("units"))
    return units.alias("u").join(middle.alias("m"), same_key("u", "m", keys)).select(
        *[f"u.{k}" for k in keys], F.col("m._q")[0].alias("median_price"), "u.units")


def brand_positioning(rows: DataFrame) -> DataFrame:
    return price_positions(rows, ["category", "brand"]).withColumn("revenue", F.col("units") * F.col("median_price"))


def brand_price_positioning(facts, products) -> DataFrame:
    """All-time median price and units per brand and category."""
    lines = facts.filter(F.col("unit_price").isNotNull())
    return price_positions(label_products(lines, products, "brand", "category"), ["brand", "category"])
