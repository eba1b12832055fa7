"""Customer reports: RFM, journeys, cohorts, membership and age groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.functions.numeric import half_even
from ledgerloom.functions.order_stats import column_medians, level, with_rank
from ledgerloom.operators.revenue import column_names, revenue_sum, share_of, top
from ledgerloom.operators.warehouse import in_range, label_products, look_up
from ledgerloom.session import cut_lineage


def new_customers(facts, calendar) -> DataFrame:
    first = (in_range(facts.filter(F.col("customer_id").isNotNull()), calendar, attrs=["date"])
             .groupBy("customer_id").agg(F.min("date").alias("first")))
    return first.groupBy(F.year("first").alias("year")).agg(F.count(F.lit(1)).alias("new_customers")).orderBy("year")


def rfm_base(orders: DataFrame) -> DataFrame:
    """One row per customer from (customer_id, day, revenue): R in days, F in dated rows, M in money.

    Written once: the three rankings and the summaries all read it.
    """
    base = cut_lineage(orders.groupBy("customer_id").agg(
        F.max("day").alias("last_order"), F.count("day").alias("F"), F.sum("revenue").alias("M"))
        .filter(F.col("last_order").isNotNull()))
    newest = F.lit(base.agg(F.max("last_order")).first()[0])
    return base.select("customer_id", F.datediff(newest, F.col("last_order")).alias("R"), "F", "M")


def rfm_scored(base: DataFrame, segment: bool = True) -> DataFrame:
    """Scores 1..5 from exact global ranks; a customer without a measure keeps its row, with a null score."""
    counts = base.agg(*[F.count(m).alias(m) for m in ("R", "F", "M")]).first()
    ranked = base
    for measure in ("R", "F", "M"):
        ranked = with_rank(ranked, measure, "customer_id", f"_rank_{measure}")
    scored = ranked.select(
        "customer_id", "R", "F", "M",
        *[F.when(F.col(m).isNotNull(), level(F.col(f"_rank_{m}"), F.lit(counts[m]), reverse=(m == "R"))).alias(f"{m}_score")
          for m in ("R", "F", "M")])
    if segment:
        digits = [F.coalesce(F.col(f"{m}_score").cast("string"), F.lit("-")) for m in ("R", "F", "M")]
        scored = scored.withColumn("segment", F.concat(*digits))
    return scored


def orders_in_range(facts, calendar, start, end) -> DataFrame:
    known = facts.filter(F.col("customer_id").isNotNull())
    return in_range(known, calendar, start, end, ["date"]).select("customer_id", F.col("date").alias("day"), "revenue")


def rfm(facts, calendar, start, end) -> DataFrame:
    return rfm_scored(rfm_base(orders_in_range(facts, calendar, start, end)))


def rfm_summary(base: DataFrame) -> DataFrame:
    mid = column_medians(base, ["M", "F"])
    return mid.agg(
        F.max(F.when(F.col("column") == "M", F.col("median"))).alias("median_monetary"),
        F.max(F.when(F.col("column") == "F", F.col("median"))).alias("median_frequency"),
    ).select(base.agg(F.count(F.lit(1))).scalar().alias("customers"), "median_monetary", "median_frequency")


def rfm_segments(scored: DataFrame, n: int = 20) -> DataFrame:
    return top(scored.groupBy("segment").agg(F.count(F.lit(1)).alias("customers")), "customers", "segment", n=n)


def rfm_drilldown(scored: DataFrame, segment: str, n: int = 200) -> DataFrame:
    return top(scored.filter(F.col("segment") == segment), "M", "customer_id", n=n)


def category_transitions(facts, calendar, products, start, end) -> DataFrame:
    """Pairs of categories a customer bought one after the other, counted.

    What counts of a stretch of a history is its first and last category and the steps inside, and two stretches in a
    row make one. A customer's history is cut into slices (day, ``tx_slice``), slices are put together by month and
    months by customer, so no task holds a history whole, however much one customer bought: the last window has a
    row per month. ``tx_slice`` must grow with the order of ``tx_id`` inside a day.
    """
    lines = in_range(facts.filter(F.col("customer_id").isNotNull()), calendar, start, end)
    rows = label_products(lines, products, "category")
    part = ["customer_id", "date_key", "tx_slice"]
    inside = Window.partitionBy(*part).orderBy("tx_id")
    stepped = rows.select(
        *part, "category", F.lead("category").over(inside).alias("next"), F.lag("category").over(inside).alias("previous"))
    within = stepped.filter(F.col("next").isNotNull()).groupBy(
        F.col("category").alias("cat_from"), F.col("next").alias("cat_to")).agg(F.count(F.lit(1)).alias("n"))
    ends = stepped.filter(F.col("next").isNull() | F.col("previous").isNull()).groupBy(*part).agg(
        F.max(F.when(F.col("previous").isNull(), F.col("category"))).alias("first"),
        F.max(F.when(F.col("next").isNull(), F.col("category"))).alias("last"))
    ends = cut_lineage(ends.withColumn("month", F.expr("date_key div 100")))
    days = steps_between(ends, ["customer_id", "month"], ["date_key", "tx_slice"])
    place = F.struct("date_key", "tx_slice")
    months = ends.groupBy("customer_id", "month").agg(F.min_by("first", place).alias("first"), F.max_by("last", place).alias("last"))
    whole = within.unionByName(days).unionByName(steps_between(months, ["customer_id"], ["month"]))
    pairs = whole.groupBy("cat_from", "cat_to").agg(F.sum("n").alias("transitions"))
    return pairs.orderBy(F.desc("transitions"), "cat_from", "cat_to")


def steps_between(stretches: DataFrame, part: list[str], order: list[str]) -> DataFrame:
    """Steps from the last category of a stretch to the first of the next one of the same ``part``, counted."""
    following = F.lead("first").over(Window.partitionBy(*part).orderBy(*order))
    steps = stretches.select(F.col("last").alias("cat_from"), following.alias("cat_to"))
    return steps.filter(F.col("cat_to").isNotNull()).groupBy("cat_from", "cat_to").agg(F.count(F.lit(1)).alias("n"))


def transition_matrix(pairs: DataFrame, categories: list[str]) -> DataFrame:
    """From by to, 0 where a step never happened; one column per category, in lower case."""
    cells = pairs.groupBy("cat_from").pivot("cat_to", categories).agg(F.sum("transitions"))
    return cells.select("cat_from", *[
        F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(name) for c, name in column_names(categories).items()])


def with_member(sums: DataFrame, customers: DataFrame) -> DataFrame:
    """The row's own membership flag, else the customer's."""
    people = customers.select("customer_id", F.col("is_prime_member").alias("_own"))
    return look_up(sums, people, "customer_id").withColumn("prime", F.coalesce("is_prime_member", "_own"))


def prime_metrics(facts, calendar, customers, start, end) -> DataFrame:
    """Per membership: orders, customers, revenue, average line, and revenue share in percent."""
    lines = in_range(facts, calendar, start, end)
    sums = lines.groupBy("customer_id", "is_prime_member").agg(revenue_sum(), F.count(F.lit(1)).alias("orders"))
    groups = with_member(sums, customers).groupBy("prime").agg(
        F.sum("orders").alias("orders"), F.count_distinct("customer_id").alias("customers"), revenue_sum())
    total = F.greatest(F.lit(1.0), F.sum("revenue").over(Window.partitionBy()).cast("double"))
    money = F.col("revenue").cast("double")
    return groups.select("prime", "orders", "customers", "revenue", (money / F.col("orders")).alias("aov"),
                         (money / total * 100).alias("revenue_share_pct"))


def prime_category_mix(facts, calendar, products, customers, start, end) -> DataFrame:
    lines = with_member(in_range(facts, calendar, start, end), customers)
    sums = lines.groupBy("prime", "product_id", "category").agg(revenue_sum())
    mix = label_products(sums, products, "category").groupBy("prime", "category").agg(revenue_sum())
    return mix.withColumn("share", share_of("revenue", "category"))


def with_age(sums: DataFrame, customers: DataFrame) -> DataFrame:
    people = customers.select("customer_id", "age_group")
    return look_up(sums, people, "customer_id").withColumn("age_group", F.coalesce("age_group", F.lit("Unknown")))


def age_revenue(facts, calendar, customers, start, end) -> DataFrame:
    sums = in_range(facts, calendar, start, end).groupBy("customer_id").agg(revenue_sum())
    return top(with_age(sums, customers).groupBy("age_group").agg(revenue_sum()), "revenue", "age_group")


def age_category_mix(facts, calendar, products, customers, start, end) -> DataFrame:
    lines = with_age(in_range(facts, calendar, start, end), customers)
    sums = lines.groupBy("age_group", "product_id", "category").agg(revenue_sum())
    mix = label_products(sums, products, "category").groupBy("age_group", "category").agg(revenue_sum())
    return mix.withColumn("share", share_of("revenue", "category"))


def cohort_active(facts, calendar, start, end) -> DataFrame:
    """Customers active ``m`` months after their first month in the range.

    Rows are cut to one per customer and month first, so the window over a customer never
    sees more rows than the range has months.
    """
    lines = in_range(facts.filter(F.col("customer_id").isNotNull()), calendar, start, end, ["year", "month"])
    months = lines.select("customer_id", (F.col("year") * 12 + F.col("month") - 1).alias("ym")).distinct()
    first = F.min("ym").over(Window.partitionBy("customer_id"))
    counted = months.select(first.alias("c"), (F.col("ym") - first).cast("int").alias("m")).groupBy("c", "m").agg(
        F.count(F.lit(1)).alias("active"))
    return counted.select(
        F.make_date(F.floor(F.col("c") / 12).cast("int"), (F.col("c") % 12 + 1).cast("int"), F.lit(1)).alias("cohort"), "m", "active")


def cohort_matrix(active: DataFrame, months: int) -> DataFrame:
    """Cohort by offset, 0 where nobody was active; columns m0..m(months)."""
    cells = active.groupBy("cohort").pivot("m", list(range(months + 1))).agg(F.sum("active"))
    return cells.select("cohort", *[F.coalesce(F.col(str(i)), F.lit(0)).alias(f"m{i}") for i in range(months + 1)])


def cohort_retention(active: DataFrame) -> DataFrame:
    """Active customers as percent of the cohort's first month, for every offset seen in any cohort."""
    cohorts = active.groupBy("cohort").agg(
        F.map_from_entries(F.collect_list(F.struct("m", "active"))).alias("by_m"))
    offsets = active.agg(F.sort_array(F.collect_set("m"))).scalar()
    grid = cohorts.select("cohort", "by_m", F.explode(offsets).alias("m"))
    share = F.try_element_at("by_m", F.col("m")) / F.try_element_at("by_m", F.lit(0))
    return grid.select("cohort", "m", half_even(F.coalesce(share * 100, F.lit(0.0)), 1).alias("retention_pct"))
