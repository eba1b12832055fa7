"""Operators against brute force, hot keys, plans and whole jobs."""

import itertools
import random
from collections import Counter
from uuid import uuid4

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.order_stats import quantiles, with_rank
from ledgerloom.config import Outliers
from ledgerloom.operators import cleaning as cl, customers as cu, forecast as fc, products as pd, revenue as rv, warehouse as wh
from ledgerloom.plans import jobs
from ledgerloom.session import shared_folder
from ledgerloom.sources import files


def skewed_values(n=3000, seed=5):
    """A third of the values are equal, the rest spread over many magnitudes and both signs."""
    rng = random.Random(seed)
    return [7.0 if i % 3 == 0 else rng.choice([-1, 1]) * round(10 ** rng.uniform(-3, 7), 3) for i in range(n)]


def test_quantiles_match_numpy(spark):
    values = skewed_values()
    rows = spark.createDataFrame([("a" if i % 5 else None, v) for i, v in enumerate(values)], "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for row in quantiles(rows, ["g"], "v", probs).collect():
        mine = [v for i, v in enumerate(values) if (i % 5 != 0) == (row["g"] == "a")]
        assert row["n"] == len(mine)
        assert np.allclose(row["q"], np.quantile(mine, probs), rtol=1e-12)
    assert quantiles(rows.limit(0), [], "v", [0.5]).count() == 0


def test_rank_is_a_permutation_in_order(spark):
    rows = spark.createDataFrame([(str(i), v) for i, v in enumerate(skewed_values())], "id string, v double")
    ranked = sorted(with_rank(rows, "v", "id", "r").collect(), key=lambda r: r["r"])
    assert [r["r"] for r in ranked] == list(range(1, 3001))
    assert [r["v"] for r in ranked] == sorted(r["v"] for r in ranked)


INF, NAN = float("inf"), float("nan")


def test_infinities_and_nan(spark):
    values = [INF, -INF, NAN, 1e308, -1e308, 5e-324, 0.0, 1.5, INF]
    rows = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id string, v double")
    known = sorted(v for v in values if v == v)
    got = quantiles(rows, [], "v", [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]).first()
    assert got["n"] == 8 and got["q"][0] == -INF and got["q"][5] == got["q"][4] == INF
    assert got["q"][2] == (known[3] + known[4]) / 2
    ranked = [r["v"] for r in sorted(with_rank(rows, "v", "id", "r").collect(), key=lambda r: r["r"])]
    assert ranked[:8] == known and ranked[8] != ranked[8]


def test_infinite_values_do_not_stop_a_column(spark):
    """A number too large for a double reads as infinity: imputation, outliers and bands go on."""
    rows = spark.createDataFrame([("1e999", "a"), ("5", "b"), (None, "c"), ("7", "d"), ("-1e999", "e"), ("6", "f")], "v string, k string")
    typed = rows.withColumn("v", F.col("v").cast("double"))
    filled = {r["k"]: r["v"] for r in cl.impute_numeric(typed, ["v"]).collect()}
    assert (filled["c"], filled["a"], filled["e"]) == (6.0, INF, -INF)
    kept = {r["k"]: r["v"] for r in cl.clean_one(cl.outliers_step, rows, Outliers("v"), ()).collect()}
    assert (kept["a"], kept["d"], kept["c"]) == (INF, 7.0, None)
    orders = typed.selectExpr("k as customer_id", "date'2020-01-01' as day", "v as revenue")
    assert {r["customer_id"]: r["M_score"] for r in cu.rfm_scored(cu.rfm_base(orders)).collect()}["a"] == 5


def baskets():
    """Small baskets, and two large ones that hold most rows."""
    rng = random.Random(3)
    orders = {f"o{i}": rng.sample(range(30), rng.randint(1, 4)) for i in range(200)}
    orders |= {"big1": list(range(0, 40)), "big2": list(range(20, 60))}
    return [(o, str(p), 20200101) for o, items in orders.items() for p in items]


@pytest.mark.parametrize("leading,n", [(400, 10), (5, 10), (5, 2000), (2, 30), (1, 25)])
def test_product_pairs_match_brute_force(spark, leading, n):
    rows = baskets()
    counts = Counter()
    for _, group in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        counts.update(itertools.combinations(sorted({p for _, p, _ in group}), 2))
    expected = sorted(((-c, a, b) for (a, b), c in counts.items()))[:n]
    facts = spark.createDataFrame(rows, "order_id string, product_id string, date_key int")
    calendar = wh.time_dimension(spark, "2020-01-01", "2020-01-02")
    got = pd.product_pairs(facts, calendar, "2020-01-01", "2020-01-02", n, leading, per_slice=3).collect()
    assert [(-r["co_occurs"], r["prod_a"], r["prod_b"]) for r in got] == expected


def test_transitions_of_one_hot_customer(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 2 else f"c{i % 7}", str(rng.randint(0, 4)), 20200101 + rng.randint(0, 3), i) for i in range(600)]
    facts = spark.createDataFrame(rows, "customer_id string, product_id string, date_key int, tx_id int").withColumns(
        {"category": F.concat(F.lit("k"), "product_id"), "tx_slice": F.floor(F.col("tx_id") / 50)})
    goods = spark.createDataFrame([], "product_id string, category string")
    calendar = wh.time_dimension(spark, "2020-01-01", "2020-01-31")
    got = {(r[0], r[1]): r[2] for r in cu.category_transitions(facts, calendar, goods, "2020-01-01", "2020-01-31").collect()}
    expected = Counter()
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r[0], r[2], r[3])), key=lambda r: r[0]):
        steps = [f"k{r[1]}" for r in group]
        expected.update(zip(steps, steps[1:]))
    assert got == dict(expected)


def test_no_window_holds_a_customer(spark):
    """A customer with nearly all rows, over years: the widest window has a row per month or per slice of a month."""
    rng = random.Random(2)
    days = [20180000 + y * 10000 + m * 100 + d for y in range(3) for m in range(1, 13) for d in (1, 15)]
    rows = [("hot" if i % 10 else f"c{i}", str(rng.randint(0, 3)), days[rng.randrange(len(days))], i) for i in range(4000)]
    facts = spark.createDataFrame(rows, "customer_id string, product_id string, date_key int, tx_id int").withColumns(
        {"category": F.concat(F.lit("k"), "product_id"), "tx_slice": F.floor(F.col("tx_id") / 40)})
    goods, calendar = spark.createDataFrame([], "product_id string, category string"), wh.time_dimension(spark, "2018-01-01", "2020-12-31")
    seen = []
    before = cu.steps_between

    def watched(stretches, part, order):
        seen.append(stretches.groupBy(*part).count().agg(F.max("count")).first()[0])
        return before(stretches, part, order)

    cu.steps_between = watched
    try:
        got = {(r[0], r[1]): r[2] for r in cu.category_transitions(facts, calendar, goods, "2018-01-01", "2020-12-31").collect()}
    finally:
        cu.steps_between = before
    expected = Counter()
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r[0], r[2], r[3])), key=lambda r: r[0]):
        steps = [f"k{r[1]}" for r in group]
        expected.update(zip(steps, steps[1:]))
    assert got == dict(expected)
    assert len(seen) == 2 and seen[0] < 200 and seen[1] == 36


def rows_scanned(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.length()))


def test_a_month_of_the_fact_reads_a_month(spark):
    days = spark.range(36_000).select(
        F.concat(F.lit("o"), "id").alias("order_id"), F.expr("date_add(date'2020-01-01', cast(id * 7 % 360 as int))").alias("order_date"),
        F.concat(F.lit("f"), F.col("id") % 2, F.lit(".csv")).alias("source_file"), (F.col("id") % 9).cast("decimal(18,2)").alias("revenue"))
    facts = days.withColumn("date_key", F.expr("year(order_date) * 10000 + month(order_date) * 100 + day(order_date)"))
    path = f"{shared_folder(spark)}/fact-{uuid4().hex}"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 48)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wh.append_fact(facts, path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    month = spark.read.parquet(path).filter("order_date between date'2020-03-01' and date'2020-03-31'")
    assert month.count() == 3100
    assert rows_scanned(month) < 3100 * 2.5  # of 36,000
    assert spark.read.parquet(path).count() == 36_000


def test_null_and_frequent_keys(spark):
    """A third of the rows without a key, a third on one: every row is there once, and nulls are dealt out."""
    rows = [(None if i % 3 == 0 else "hot" if i % 3 == 1 else f"p{i % 50}", i) for i in range(3000)]
    facts = spark.createDataFrame(rows, "product_id string, n int").withColumn("category", F.lit(None).cast("string"))
    goods = spark.createDataFrame([("hot", "H"), ("", "empty"), (None, "null")] + [(f"p{i}", "P") for i in range(40)], "product_id string, category string")
    got = Counter((r["product_id"], r["category"]) for r in wh.label_products(facts, goods, "category").collect())
    want = Counter((p, "H" if p == "hot" else "P" if p and int(p[1:]) < 40 else "Unknown") for p, _ in rows)
    assert got == want
    places = wh.look_up(facts, goods.withColumnRenamed("category", "c"), "product_id")
    assert "_place_of" in plan_of(places)
    keyed = facts.withColumn("id", F.lit(None).cast("int"))
    assert wh.look_up(keyed, spark.createDataFrame([(0, "zero")], "id int, v string"), "id").filter("v is not null").count() == 0


def test_shares_and_retention(retail):
    facts = retail.transactions("order_date", "date_key", "product_id", "category", "revenue", "customer_id")
    shares = rv.category_share(facts, retail.calendar(), retail.products(), *retail.span())
    assert abs(shares.agg(F.sum("share")).first()[0] - 1) < 1e-9
    kept = cu.cohort_retention(cu.cohort_active(facts, retail.calendar(), *retail.span()))
    assert {r[0] for r in kept.filter("m = 0").select("retention_pct").distinct().collect()} == {100.0}


def test_empty_range_gives_empty_or_null(retail):
    facts = retail.transactions("order_date", "date_key", "product_id", "category", "revenue", "customer_id")
    day = ("1995-01-01", "1995-01-01")
    none = facts.limit(0)
    assert rv.category_share(none, retail.calendar(), retail.products(), *day).count() == 0
    row = rv.kpi_summary(none, retail.calendar(), retail.products(), *day).first()
    assert (row["revenue"], row["active_customers"], row["aov"]) == (None, 0, None)
    assert cu.rfm(none, retail.calendar(), *day).count() == 0
    assert rv.monthly_trend(none, retail.calendar()).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_operators_have_no_single_task(retail):
    facts = retail.transactions("order_date", "date_key", "product_id", "category", "customer_id", "tx_id", "tx_slice")
    steps = cu.category_transitions(facts, retail.calendar(), retail.products(), *retail.span())
    first = wh.upsert_customers(retail.customers().select("customer_id", "city", "state", "is_prime_member"),
                                retail.transactions("customer_id", "city", "state", "is_prime_member", "order_date", "tx_id"),
                                F.struct("order_date", "tx_id"))
    for df in (steps, first):
        assert "SinglePartition" not in plan_of(df)


def test_date_range_reaches_the_scan(retail):
    facts = retail.transactions("order_date", "date_key", "revenue")
    plan = plan_of(rv.command_summary(facts.withColumn("customer_id", F.lit("x")), retail.calendar(), "1996-01-01", "1996-12-31"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1996-01-01" in plan
    assert "p_type" not in plan and "c_name" not in plan


def test_forecast_follows_a_seasonal_line(spark):
    months = [(f"{2000 + i // 12}-{i % 12 + 1:02d}-01", 100.0 + 5 * i + 20 * np.sin(2 * np.pi * (i % 12) / 12)) for i in range(60)]
    rows = spark.createDataFrame([("long", d, float(v)) for d, v in months[:48]] + [("short", d, float(v)) for d, v in months[:20]],
                                 "series string, ym string, revenue double").withColumn("ym", F.col("ym").cast("date"))
    out = fc.revenue_forecast(rows, 12)
    ahead = {str(r["ym"]): r["revenue"] for r in out.filter("series = 'long' and type = 'forecast'").collect()}
    assert len(ahead) == 12
    assert all(abs(ahead[d] - v) < 0.05 * v for d, v in months[48:])
    short = out.filter("series = 'short' and type = 'forecast'").collect()
    assert len(short) == 12 and all(r["revenue"] is None and r["note"] for r in short)


def test_pick_columns_needs_date_and_revenue(spark):
    rows = spark.createDataFrame([("2020-01-01", "5")], "date string, qty string")
    assert wh.pick_columns(rows) is None
    assert wh.normalize_fact(rows.withColumn("amount", F.lit("2")), F.lit("f")).first()["quantity"] == 5
    no_quantity = wh.normalize_fact(rows.select("date", F.lit("2").alias("total")), F.lit("f")).first()
    assert (no_quantity["quantity"], no_quantity["revenue"], no_quantity["date_key"]) == (1, 2, 20200101)


def test_catalog_needs_a_key(spark, retail):
    bad = spark.createDataFrame([("x",)], "product_name string")
    with pytest.raises(ValueError):
        wh.upsert_products(retail.products(), bad, F.lit(1))
    only_key = wh.upsert_products(retail.products(), spark.createDataFrame([("new",), ("new",)], "product_id string"), F.lit(1))
    assert only_key.count() == retail.products().count() + 1


def test_clean_folder_then_load(spark):
    base = f"{shared_folder(spark)}/job-{uuid4().hex}"
    sales = spark.createDataFrame([
        ("t1", "01/02/2020", "c1", "007", "Rs 1,200", "Bombay", "Yes", "PhonePe"),
        ("t2", "02/02/2020", "c1", "008", "900", "Dehli", "No", "cash on delivery"),
        ("t2", "02/02/2020", "c1", "008", "900", "Dehli", "No", "cash on delivery"),
    ], "transaction_id string, order_date string, customer_id string, product_id string, original_price_inr string, "
       "customer_city string, is_prime_member string, payment_method string")
    goods = spark.createDataFrame([("007", "Lamp", "Home & Garden", None), ("008", "Fan", None, "10")],
                                  "product_id string, product_name string, category string, base_price_2015 string")
    files.csv_writer(sales.coalesce(1)).csv(f"{base}/in/sales 2020.csv")
    files.csv_writer(goods.coalesce(1)).csv(f"{base}/in/goods_catalog.csv")
    report = jobs.clean_folder(spark, f"{base}/in", f"{base}/out")
    kept = {(r["file"], r["metric"]): r["value"] for r in report.filter("metric in ('rows_before', 'rows_after')").collect()}
    assert kept == {("sales 2020.csv", "rows_before"): 3, ("sales 2020.csv", "rows_after"): 2,
                    ("goods_catalog.csv", "rows_before"): 2, ("goods_catalog.csv", "rows_after"): 2}
    assert jobs.clean_folder(spark, f"{base}/in", f"{base}/out") is None  # nothing new

    tables = jobs.load_folder(spark, f"{base}/out/data", f"{base}/warehouse")
    rows = sorted(tuple(r) for r in tables["transactions"].select("order_id", "date_key", "revenue", "city", "payment_method", "product_id").collect())
    assert [(r[0], r[1], float(r[2]), *r[3:]) for r in rows] == [
        ("t1", 20200201, 1200.0, "Mumbai", "UPI", "007"), ("t2", 20200202, 900.0, "Dehli", "Cash on Delivery", "008")]
    assert tables["customers"].collect()[0]["city"] == "Mumbai"
    assert {r[0] for r in tables["products"].select("product_id").collect()} == {"007", "008"}
    again = jobs.load_folder(spark, f"{base}/out/data", f"{base}/warehouse")
    assert again["transactions"].count() == 2
