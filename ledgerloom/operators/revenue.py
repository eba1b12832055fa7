"""Revenue totals, trends, shares and calendars.

Reports by product label sum per product before the product join: the join then sees one row
per product and period instead of every order line, and a best-seller is no hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.numeric import half_even
from ledgerloom.operators.warehouse import in_range, label_products

def column_names(labels: Sequence[str]) -> dict[str, str]:
    """A column name per label: in lower case, numbered where labels differ in case alone."""
    names: dict[str, str] = {}
    for label in labels:
        name, n = label.lower(), 2
        while name in names.values():
            name, n = f"{label.lower()}_{n}", n + 1
        names[label] = name
    return names


def revenue_sum() -> Column:
    return F.sum("revenue").alias("revenue")


def whole() -> Window:
    """All rows of an already aggregated, small result."""
    return Window.partitionBy()


def share_of(value: str, *within: str) -> Column:
    return F.col(value).cast("double") / F.sum(value).over(Window.partitionBy(*within)).cast("double")


def top(df: DataFrame, value: str, *ties: str, n: int | None = None) -> DataFrame:
    ordered = df.orderBy(F.desc(value), *ties)
    return ordered.limit(n) if n is not None else ordered


def by_label(facts: DataFrame, calendar: DataFrame | None, products: DataFrame, label: str, start=None, end=None,
             periods: Sequence[str] = (), own: bool = True, sums: Sequence[str] = ("revenue",),
             more: Sequence[str] = ()) -> DataFrame:
    """Sums per (periods, more, label), aggregated per product before the product join."""
    rows = facts if calendar is None else in_range(facts, calendar, start, end, periods)
    kept = [label] if own and label in rows.columns else []
    small = rows.groupBy("product_id", *kept, *periods, *more).agg(*[F.sum(s).alias(s) for s in sums])
    return (
        label_products(small, products, label, own=own)
        .groupBy(*periods, *more, label).agg(*[F.sum(s).alias(s) for s in sums])
    )


def distinct_labels(products: DataFrame, facts: DataFrame, label: str, categories: Sequence[str] | None = None) -> DataFrame:
    sides = [df if categories is None else df.filter(F.col("category").isin(list(categories))) for df in (products, facts)]
    both = sides[0].select(label).distinct().union(sides[1].select(label).distinct())
    return both.filter(F.col(label).isNotNull()).distinct().orderBy(label)


def only_product_categories(facts: DataFrame, products: DataFrame, categories: Sequence[str] | None) -> DataFrame:
    """Rows whose product (not the row itself) is in one of the categories."""
    if not categories:
        return facts
    chosen = products.filter(F.col("category").isin(list(categories))).select("product_id")
    return facts.join(chosen, "product_id", "left_semi")


def kpi_summary(facts, calendar, products, start, end, categories=None) -> DataFrame:
    rows = only_product_categories(in_range(facts, calendar, start, end), products, categories)
    return rows.agg(revenue_sum(), F.count_distinct("customer_id").alias("active_customers"), F.count(F.lit(1)).alias("_n")).select(
        "revenue", "active_customers", F.try_divide(F.col("revenue").cast("double"), F.col("_n")).alias("aov"))


def revenue_yoy(facts, calendar, start, end) -> DataFrame:
    """Both ranges in one scan; Feb 29 falls back to Feb 28."""
    def a_year_back(day: str) -> Column:
        return F.add_months(F.lit(day).cast("date"), -12)

    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    day = F.col("order_date")
    near = facts.filter((day >= a_year_back(start)) & (day <= last))
    rows = in_range(near, calendar)
    now = F.sum(F.when(day.between(first, last), F.col("revenue")))
    before = F.sum(F.when(day.between(a_year_back(start), a_year_back(end)), F.col("revenue")))
    out = rows.agg(F.coalesce(now, F.lit(0)).cast("double").alias("revenue"),
                   F.coalesce(before, F.lit(0)).cast("double").alias("previous"))
    return out.withColumn("delta_pct", F.try_divide(F.col("revenue") - F.col("previous"), F.col("previous")) * 100)


def revenue_by_year(facts, calendar, products, start, end, categories=None) -> DataFrame:
    rows = only_product_categories(in_range(facts, calendar, start, end, ["year"]), products, categories)
    return rows.groupBy("year").agg(revenue_sum()).orderBy("year")


def top_categories(facts, calendar, products, start, end, n=10) -> DataFrame:
    return top(by_label(facts, calendar, products, "category", start, end), "revenue", "category", n=n)


def against_target(totals: DataFrame, as_of: str, target: float) -> DataFrame:
    """Run rate and progress for one row of (revenue, customers, orders) of a month up to ``as_of``."""
    day, length = F.dayofmonth(F.lit(as_of).cast("date")), F.dayofmonth(F.last_day(F.lit(as_of).cast("date")))
    goal = F.lit(float(target))
    return totals.select(
        "revenue", "customers", "orders",
        (F.col("revenue") / day * length).alias("run_rate"),
        (F.coalesce(F.try_divide(F.col("revenue"), goal), F.lit(0.0)) * 100).alias("achieved_pct"),
        (F.col("revenue") < goal * (day / length)).alias("behind_target"))


def mtd_metrics(facts, calendar, as_of: str, target: float) -> DataFrame:
    totals = in_range(facts, calendar, as_of[:8] + "01", as_of).agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).cast("double").alias("revenue"),
        F.count_distinct("customer_id").alias("customers"), F.count(F.lit(1)).alias("orders"))
    return against_target(totals, as_of, target)


def daily_revenue(facts, calendar, year: int, month: int) -> DataFrame:
    days = calendar.filter((F.col("year") == year) & (F.col("month") == month))
    keys = year * 10000 + month * 100
    near = facts.filter(F.col("date_key").between(keys + 1, keys + 31))
    return in_range(near, days, attrs=["date"]).groupBy("date").agg(revenue_sum()).orderBy("date")


def top_share(totals: DataFrame, label: str, n: int) -> DataFrame:
    return top(totals, "revenue", label, n=n).withColumn("share", share_of("revenue"))


def brand_share_by_product(facts, products, n=10) -> DataFrame:
    """All-time brand totals by the product's own brand; share among the first ``n``."""
    return top_share(by_label(facts, None, products, "brand", own=False), "brand", n)


def brand_share(facts, calendar, products, start, end, n=15) -> DataFrame:
    return top_share(by_label(facts, calendar, products, "brand", start, end), "brand", n)


def brand_trend(facts, calendar, products, start, end) -> DataFrame:
    return by_label(facts, calendar, products, "brand", start, end, ["year"]).orderBy("year", "brand")


def geo_expansion(facts, calendar) -> DataFrame:
    """Per year and state: distinct cities and revenue. Cities are grouped first, so the
    distinct count is a plain count over a small table."""
    cities = in_range(facts, calendar, attrs=["year"]).groupBy("year", "state", "city").agg(revenue_sum())
    return cities.groupBy("year", "state").agg(F.count("city").alias("cities"), revenue_sum())


def cities_covered(facts, calendar) -> DataFrame:
    return geo_expansion(facts, calendar).groupBy("year").agg(F.sum("cities").alias("cities")).orderBy("year")


def revenue_by_category_of_product(facts, products, n=20) -> DataFrame:
    return top(by_label(facts, None, products, "category", own=False), "revenue", "category", n=n)


def with_line(df: DataFrame, x: str, at_least: int, y: str = "revenue", out: str = "trend") -> DataFrame:
    """Least-squares line of ``y`` on ``x`` over the few rows of a period series."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    slope, base = F.regr_slope(ys, xs).over(whole()), F.regr_intercept(ys, xs).over(whole())
    return df.withColumn(out, F.when(F.count(F.lit(1)).over(whole()) >= at_least, base + slope * xs))


def numbered_periods(df: DataFrame, keys: Sequence[str], out: str = "period") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.orderBy(*keys)) - 1)


def monthly_trend(facts, calendar, at_least=6) -> DataFrame:
    months = in_range(facts, calendar, attrs=["year", "month"]).groupBy("year", "month").agg(revenue_sum())
    return with_line(numbered_periods(months, ["year", "month"]), "period", at_least)


PERIOD_KEYS = {"month": ["year", "month"], "quarter": ["year", "quarter"], "year": ["year"]}


def period_revenue(facts, calendar, products, start, end, freq="month", categories=None) -> DataFrame:
    """Revenue per period; the category filter is on the product's category, else the row's."""
    keys = PERIOD_KEYS[freq]
    if not categories:
        return in_range(facts, calendar, start, end, keys).groupBy(*keys).agg(revenue_sum())
    labelled = by_label(facts, calendar, products, "category", start, end, keys)
    return labelled.filter(F.col("category").isin(list(categories))).groupBy(*keys).agg(revenue_sum())


def revenue_trend(facts, calendar, products, start, end, freq="month", categories=None) -> DataFrame:
    periods = period_revenue(facts, calendar, products, start, end, freq, categories)
    return with_line(numbered_periods(periods, PERIOD_KEYS[freq], "period_idx"), "period_idx", 2)


def growth_rates(facts, calendar, products, start, end, freq="month", categories=None) -> DataFrame:
    """Growth against the previous period that has rows, in percent."""
    keys = PERIOD_KEYS[freq]
    periods = period_revenue(facts, calendar, products, start, end, freq, categories)
    now = F.col("revenue").cast("double")
    previous = F.lag(now).over(Window.orderBy(*keys))
    return periods.select(
        *keys, half_even(now, 2).alias("revenue"), half_even(previous, 2).alias("previous"),
        half_even(F.try_divide(now - previous, previous) * 100, 2).alias("growth_pct"))


def seasonal_pattern(facts, calendar, products, start, end, categories=None) -> DataFrame:
    """Average of the monthly totals per calendar month."""
    months = period_revenue(facts, calendar, products, start, end, "month", categories)
    return months.groupBy("month").agg((F.sum("revenue").cast("double") / F.count(F.lit(1))).alias("avg_month_rev")).orderBy("month")


def category_share(facts, calendar, products, start, end) -> DataFrame:
    totals = by_label(facts, calendar, products, "category", start, end)
    return totals.withColumn("share", share_of("revenue")).orderBy(F.desc("revenue"), "category")


def category_trend_share(facts, calendar, products, start, end) -> DataFrame:
    totals = by_label(facts, calendar, products, "category", start, end, ["year"])
    return totals.withColumn("share", share_of("revenue", "year")).orderBy("year", "category")


def place_revenue(facts, calendar, start, end, place: str, n: int | None = None) -> DataFrame:
    rows = in_range(facts, calendar, start, end).groupBy(place).agg(revenue_sum())
    return top(rows.withColumn(place, F.coalesce(place, F.lit("Unknown"))).groupBy(place).agg(revenue_sum()), "revenue", place, n=n)


# First and last day (month, day) of the built-in festivals.
FESTIVALS = {"Diwali": ((11, 1), (11, 14)), "Prime Day": ((7, 15), (7, 16))}


def festival_days(calendar: DataFrame, years: Sequence[int], window: int = 7,
                  custom: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """(festival, year, period, date_key, date): one row per labelled day.

    The result holds a few days per festival and year, however large the fact is.
    """
    spark = calendar.sparkSession
    spans = [(name, y, f"{y}-{a:02d}-{b:02d}", f"{y}-{c:02d}-{d:02d}")
             for y in years for name, ((a, b), (c, d)) in FESTIVALS.items()]
    spans += [(name, int(a[:4]), a, b) for name, (a, b) in (custom or {}).items()]
    rows = spark.createDataFrame(spans, "festival string, year int, first string, last string").select(
        "festival", "year", F.col("first").cast("date").alias("first"), F.col("last").cast("date").alias("last"))

    def part(label: str, a: Column, b: Column) -> Column:
        return F.struct(F.lit(label).alias("period"), a.alias("a"), b.alias("b"))

    parts = rows.select("festival", "year", F.explode(F.array(
        part("before", F.date_sub("first", window), F.date_sub("first", 1)),
        part("during", F.col("first"), F.col("last")),
        part("after", F.date_add("last", 1), F.date_add("last", window)))).alias("p"))
    days = parts.select("festival", "year", "p.period", F.explode(F.sequence("p.a", "p.b")).alias("date"))
    return days.join(F.broadcast(calendar.select("date", "date_key")), "date")


def festival_windows(facts, labelled_days: DataFrame) -> DataFrame:
    """Daily revenue of each labelled day; one equi-join on the day for all festivals."""
    wanted = F.broadcast(labelled_days.select("date_key").distinct())
    daily = facts.join(wanted, "date_key", "left_semi").groupBy("date_key").agg(revenue_sum())
    return daily.join(F.broadcast(labelled_days), "date_key").select("festival", "year", "period", "date", "revenue")


def festival_summary(facts, labelled_days: DataFrame) -> DataFrame:
    totals = festival_windows(facts, labelled_days).groupBy("festival", "year", "period").agg(revenue_sum())
    labels = labelled_days.select("festival", "year", "period").distinct()
    return labels.join(totals, ["festival", "year", "period"], "left").select(
        "festival", "year", "period", F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue"))


def month_matrix(periods: DataFrame, row: str = "year") -> DataFrame:
    """Rows by month 1..12 with 0 for months without revenue; columns m1..m12."""
    cells = periods.groupBy(row).pivot("month", list(range(1, 13))).agg(F.sum("revenue"))
    return cells.select(row, *[F.coalesce(F.col(str(m)).cast("double"), F.lit(0.0)).alias(f"m{m}") for m in range(1, 13)])


def seasonal_matrix(facts, calendar) -> DataFrame:
    months = in_range(facts, calendar, attrs=["year", "month"]).groupBy("year", "month").agg(revenue_sum())
    return month_matrix(months)


def command_summary(facts, calendar, start, end) -> DataFrame:
    return in_range(facts, calendar, start, end).agg(
        revenue_sum(), F.count(F.lit(1)).alias("orders"), F.count_distinct("customer_id").alias("customers"))
