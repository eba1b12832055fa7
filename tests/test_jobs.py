"""Whole jobs, and rows at the edges that must not get lost."""

import os
import subprocess
import sys
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.order_stats import order_bucket, with_rank
from ledgerloom.config import CleaningConfig, Dedup, Missing
from ledgerloom.operators import cleaning, customers, products, revenue, warehouse as wh
from ledgerloom.operators.exploring import payment_share_matrix
from ledgerloom.plans import jobs
from ledgerloom.session import shared_folder
from ledgerloom.sources import files
from ledgerloom.streaming import monitor


@pytest.fixture
def base(spark):
    return f"{shared_folder(spark)}/jobs-{uuid4().hex}"


def test_buckets_split_crowded_values(spark):
    crowds = {"small": "id / 1e8", "large": "1.7e9 + id", "negative": "-5 - id / 1e4"}
    rows = spark.range(100_000).select("id", *[F.expr(e).cast("double").alias(c) for c, e in crowds.items()])
    for c in crowds:
        b = rows.select("id", order_bucket(F.col(c)).alias("b"))
        assert b.select("b").distinct().count() > 3
        assert b.groupBy("b").count().agg(F.max("count")).first()[0] < 50_000
        gaps = b.selectExpr("b - lag(b) over (order by id) as gap").agg(F.min("gap"), F.max("gap")).first()
        assert gaps[1] <= 0 if c == "negative" else gaps[0] >= 0


def test_null_measures_are_ranked_last(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 2.0), ("d", None)], "id string, v double")
    got = {r["id"]: r["r"] for r in with_rank(rows, "v", "id", "r").collect()}
    assert (got["a"], got["c"]) == (1, 2) and sorted((got["b"], got["d"])) == [3, 4]


def test_customer_without_revenue_keeps_its_row(spark):
    orders = spark.createDataFrame([("a", "2020-01-01", 5.0), ("b", "2020-01-02", None), ("c", "2020-01-03", 7.0)],
                                   "customer_id string, day string, revenue double").withColumn("day", F.col("day").cast("date"))
    got = {r["customer_id"]: r for r in customers.rfm_scored(customers.rfm_base(orders)).collect()}
    assert got["b"]["M_score"] is None and got["b"]["segment"].endswith("-")
    assert (got["a"]["M_score"], got["c"]["M_score"]) == (3, 5)


def test_every_payment_method_has_a_column(spark):
    shares = spark.createDataFrame([(2020, m, 1.0, 1 / 6) for m in "abcdef"], "year int, payment_method string, revenue double, share double")
    assert payment_share_matrix(shares).columns == ["year", *[f"s{i}" for i in range(6)]]


def test_labels_that_differ_in_case(spark):
    assert list(revenue.column_names(["Home", "HOME", "x"]).values()) == ["home", "home_2", "x"]


def test_late_sales_and_replays_count_once(spark, base):
    def arrive(name, rows):
        sales = spark.createDataFrame(rows, "ts string, customer_id string, revenue int").withColumns(
            {"ts": F.col("ts").cast("timestamp"), "revenue": F.col("revenue").cast("decimal(18,2)")})
        sales.repartition(2).write.parquet(f"{base}/in/{name}.parquet")  # a table of part files

    def run():
        sales = monitor.file_stream(spark, f"{base}/in", "*.parquet")
        monitor.start_monitor(sales, f"{base}/days", f"{base}/progress").awaitTermination()
        return monitor.month_to_date(spark, f"{base}/days", "2024-01-31", 100.0).first()

    arrive("a", [("2024-01-20 10:00:00", "x", 1), ("2024-01-21 10:00:00", "y", 2)])
    assert run()["orders"] == 2
    arrive("b", [("2024-01-05 10:00:00", "x", 4)])
    late = run()
    assert (late["orders"], late["revenue"], late["customers"]) == (3, 7.0, 2)
    assert run()["orders"] == 3
    assert monitor.daily_revenue(spark, f"{base}/days", 2024, 1).count() == 3


def test_unreadable_file_stops_a_job(spark, base):
    files.csv_writer(spark.createDataFrame([("1", "2")], "order_date string, revenue string").coalesce(1)).csv(f"{base}/in/good.csv")
    with pytest.raises(ValueError, match="unreadable"):
        files.scan_files(spark, [f"{base}/in/good.csv", f"{base}/in/absent.csv"])
    assert files.scan_files(spark, [f"{base}/in/good.csv", f"{base}/in/absent.csv"], skip_unreadable=True).count() == 1


def test_types_are_settled_per_file(spark, base):
    def put(name, rows, columns):
        files.csv_writer(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).coalesce(1)).csv(f"{base}/in/{name}.csv")

    names = ["id", "n", "flag", "day", "code"]
    put("numbers", [("1", "5", "True", "2020-01-02", "007"), ("2", None, "false", None, "008"), ("3", "7", None, "2020-02-03", "1")], names)
    put("texts one", [("1", "five", "yes", "2020-01-02", "x"), ("2", None, "no", "3 May", "x"), ("3", "five", "no", "2020-02-03", "y")], names)
    put("more numbers", [("4", "1e999", "true", "2021-01-01", "07"), ("5", "-2.5", "true", "2021-01-01", "08"), ("6", None, None, None, None)], names)
    put("other", [("a", "1")], ["key", "n"])
    paths = [r.path for r in files.list_csv(spark, f"{base}/in").collect()]
    got = {}
    for scan in files.scan_groups(spark, paths, types=True):
        kinds = dict(scan.dtypes)
        for row in scan.select("source_file").distinct().collect():
            got[row[0]] = [kinds[c] for c in scan.columns[: scan.columns.index("source_file")]]
    assert got == {
        "numbers.csv": ["bigint", "bigint", "boolean", "date", "string"],
        "texts one.csv": ["bigint", "string", "string", "string", "string"],
        "more numbers.csv": ["bigint", "double", "boolean", "date", "string"],
        "other.csv": ["string", "bigint"],
    }
    cfg = CleaningConfig(missing=Missing(include=("n",)))
    jobs.clean_folder(spark, f"{base}/in", f"{base}/out", configs={"transactions": cfg})

    def column(name):
        rows = spark.read.option("header", True).csv(f"{base}/out/data/source_file={name}").collect()
        return {r["id"]: r["n"] for r in rows}

    assert column("numbers.csv")["2"] == "6.0" and column("texts one.csv")["2"] == "five"  # median here, mode there
    assert column("more numbers.csv")["6"] == "Infinity"


def test_headers_of_many_files_take_one_scan(spark, base):
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(200)], "k int, v string")
    rows.repartition(200, "k").write.option("header", True).csv(f"{base}/many/a.csv")
    rows.limit(1).coalesce(1).write.option("header", True).csv(f"{base}/many/b.csv")
    paths = [r.path for r in files.list_csv(spark, f"{base}/many/a.csv").collect()] + [f"{base}/many/b.csv"]
    assert len(paths) > 100
    tracker, group = spark.sparkContext.statusTracker(), f"headers-{uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "headers")
    found, failed = files.headers(spark, paths)
    jobs_run = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("rest", "rest")
    assert failed == {} and list(found) == [("k", "v")] and sum(map(len, found.values())) == len(paths)
    assert jobs_run < 6
    assert files.column_names('a,"b,c",,A') == ["a0", "b,c", "_c2", "A3"]


def test_a_clean_file_has_few_parts(spark, base):
    for i in range(6):
        rows = [(str(n), f"k{n % 50}", str(n % 7)) for n in range(300)]
        files.csv_writer(spark.createDataFrame(rows, "id string, k string, v string").repartition(4)).csv(f"{base}/in/f{i}.csv")
    jobs.clean_folder(spark, f"{base}/in", f"{base}/out", configs={"transactions": CleaningConfig(dedup=Dedup(("k",)))})
    written = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{base}/out/data").filter("path like '%.csv'")
    assert 6 <= written.count() <= 8
    assert spark.read.option("header", True).csv(f"{base}/out/data").count() == 300


def test_first_rows_of_files_without_sorting_rows(spark, base):
    rows = [(str(i), f"k{i % 40}", f"row {i}") for i in range(2000)]
    files.csv_writer(spark.createDataFrame(rows, "id string, k string, v string").coalesce(1)).csv(f"{base}/in/a.csv")
    scan, = files.scan_groups(spark, [f"{base}/in/a.csv"])
    copy, _ = cleaning.copied(scan, [])
    kept = cleaning.deduplicate(cleaning.with_position(copy), Dedup(("k",)), F.col("_position"))
    assert {r["id"] for r in kept.collect()} == {str(i) for i in range(40)}
    narrow = cleaning.with_position(copy).groupBy("k").agg(F.min("_position"), F.count(F.lit(1)))
    for df in (kept, narrow):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def sales_csv(spark, path, rows):
    schema = "transaction_id string, date string, customer_id string, product_id string, category string, total string, city string"
    files.csv_writer(spark.createDataFrame(rows, schema).coalesce(1)).csv(path)


def test_two_loads_in_turn_and_reports_on_them(spark, base):
    sales_csv(spark, f"{base}/one/a.csv", [("t1", "2020-01-01", "c1", "p1", "A", "5", "X\nY"), ("t2", "2020-02-01", "c1", "p2", "B", "6", "X"),
                                           ("t3", "2020-03-01", "c2", "p1", "A", "7", "Z")])
    sales_csv(spark, f"{base}/two/b.csv", [("t4", "2031-01-01", "c9", "p9", "C", "8", "W")])
    first = jobs.load_folder(spark, f"{base}/one", f"{base}/wh")
    assert first["transactions"].count() == 3
    t = jobs.load_folder(spark, f"{base}/two", f"{base}/wh")
    assert t["transactions"].count() == 4
    assert {r[0] for r in t["customers"].select("customer_id").collect()} == {"c1", "c2", "c9"}
    assert {r[0] for r in t["products"].select("product_id").collect()} == {"p1", "p2", "p9"}
    assert t["key_report"].collect() == []
    star = (t["transactions"], t["time_dimension"], t["products"], t["customers"])
    assert wh.star_view(*star).count() == 4  # the day outside the given calendar is there too
    span = ("2020-01-01", "2031-12-31")
    steps = {(r["cat_from"], r["cat_to"]): r["transitions"] for r in customers.category_transitions(*star[:3], *span).collect()}
    assert steps == {("A", "B"): 1}
    assert customers.prime_metrics(star[0], star[1], star[3], *span).count() == 1
    assert sum(r["revenue"] for r in customers.age_revenue(star[0], star[1], star[3], *span).collect()) == 26
    assert products.product_pairs(star[0], star[1], *span).collect() == []


def test_unknown_keys_are_reported_or_refused(spark, base, monkeypatch):
    sales_csv(spark, f"{base}/in/a.csv", [("t1", "2020-01-01", "c1", "p1", "A", "5", "X")])
    monkeypatch.setattr(wh, "upsert_customers", lambda existing, facts, order: existing)
    t = jobs.load_folder(spark, f"{base}/in", f"{base}/wh")
    assert [(r["fk"], r["key"], r["n"]) for r in t["key_report"].collect()] == [("customer_id", "c1", 1)]
    with pytest.raises(ValueError, match="keys"):
        jobs.load_folder(spark, f"{base}/in", f"{base}/wh", refuse_unknown_keys=True)


def test_workers_need_no_installed_package(tmp_path):
    """A session from another working folder: the package is sent along."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from ledgerloom.session import build_session
from ledgerloom.functions.cities import close_city
spark = build_session("away", "local[1]", spark__ui__enabled="false")
from pyspark.sql import functions as F
print("FOUND", spark.createDataFrame([("Hydrabad",)], "c string").select(close_city(["Hyderabad"], 0.8)(F.col("c"))).first()[0])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "FOUND Hyderabad" in out.stdout, out.stderr[-800:]


def test_numbers_read_as_text_get_their_median(spark, base):
    rows = [("1", "1"), ("2", "1"), ("3", "5"), ("4", "9"), ("5", None)]
    files.csv_writer(spark.createDataFrame(rows, "order_id string, quantity string").coalesce(1)).csv(f"{base}/in/sales.csv")
    jobs.clean_folder(spark, f"{base}/in", f"{base}/out")
    out = spark.read.option("header", True).csv(f"{base}/out/data/source_file=sales.csv").collect()
    assert {r["order_id"]: float(r["quantity"]) for r in out} == {"1": 1, "2": 1, "3": 5, "4": 9, "5": 3}


def test_calendar_follows_the_orders(spark, base, tmp_path):
    """An order of 2030 is in the reports, without a fixed calendar to fall out of."""
    import shutil

    from compare import differences, duck
    from conftest import SF

    from ledgerloom.plans import ORACLES, QUERIES, load_all

    load_all()
    folder = f"{tmp_path}/late"
    shutil.copytree(SF, folder)
    os.remove(f"{folder}/orders.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    kind = orders.schema["o_orderdate"].dataType
    first = orders.agg(F.min("o_orderkey")).first()[0]
    late = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") == first, F.lit("2030-06-01").cast(kind)).otherwise(F.col("o_orderdate")))
    late.write.parquet(f"{tmp_path}/orders.parquet")
    spark.read.parquet(f"{tmp_path}/orders.parquet").toPandas().to_parquet(f"{folder}/orders.parquet", coerce_timestamps="us")
    con = duck(folder)
    for key in ("bi_revenue_by_year", "bi_category_share", "eda_yearly_trend", "wh_star_view", "bi_cohort_active"):
        assert differences(QUERIES[key](spark, folder), con, ORACLES[key]) == "", key
    assert {r["year"] for r in QUERIES["bi_revenue_by_year"](spark, folder).collect()} >= {1995, 2030}
    assert {r["year"] for r in QUERIES["eda_yearly_trend"](spark, folder).collect()} >= {1995, 2030}


def test_headers_and_types_without_sorting_lines(spark, tmp_path, monkeypatch):
    """The first lines come from a map of one entry per file, and the types from one scan."""
    import contextlib
    import io

    from ledgerloom.sources import files

    (tmp_path / "a.csv").write_text("\n\nid,day\n1,2020-01-05\n2,2020-01-06\n")
    kind = type(spark.range(1))
    plans, collect = [], kind.collect

    def collected(df):
        with contextlib.redirect_stdout(io.StringIO()) as out:
            df.explain()
        plans.append(out.getvalue())
        return collect(df)

    monkeypatch.setattr(kind, "collect", collected)
    groups, failed = files.headers(spark, [f"{tmp_path}/a.csv"])
    assert list(groups) == [("id", "day")] and not failed
    kinds = files.typed_groups(spark, groups[("id", "day")], ["id", "day"])
    monkeypatch.undo()
    assert list(kinds) == [(1, 8)]
    assert "ObjectHashAggregate(keys=[path" in plans[0] and "SortAggregate(keys=[path" not in plans[0]
    assert plans[1].count("FileScan csv") == 1


def test_parts_grow_with_rows(spark):
    """A large join is dealt into parts of bounded rows, a small one into as many as the session says."""
    from ledgerloom import session

    assert session.dealt(spark.range(100), 40 * session.ROWS_PER_PART, "id").rdd.getNumPartitions() == 40
    assert "RepartitionByExpression" not in session.dealt(spark.range(100), 100, "id")._jdf.queryExecution().logical().toString()


def test_a_folder_is_parsed_and_cleaned_once(spark, base, monkeypatch):
    """One scan reads the CSVs' columns, and one works through the value rules; statistics, report and result read what it wrote."""
    from pyspark.sql import DataFrameWriter

    rows = [(str(i), f"k{i % 5}", f"{i}/5", ["Bengalurru", "Pune", None][i % 3]) for i in range(60)]
    files.csv_writer(spark.createDataFrame(rows, "id string, k string, rating string, city string").coalesce(2)).csv(f"{base}/in/a.csv")
    cfg = CleaningConfig.from_dict({"ratings": {"column": "rating"}, "geo": {"city_field": "city", "canonical_cities": ["Bengaluru", "Pune"]},
                                    "dedup": {"key_fields": ["k"]}, "outliers": {"column": "rating"}})
    plans, kind = [], type(spark.range(1))

    def noted(real, frame):
        def run(self, *args, **options):
            plans.append(frame(self)._jdf.queryExecution().executedPlan().toString())
            return real(self, *args, **options)
        return run

    for name in ("parquet", "csv", "json"):
        monkeypatch.setattr(DataFrameWriter, name, noted(getattr(DataFrameWriter, name), lambda w: w._df))
    monkeypatch.setattr(kind, "collect", noted(kind.collect, lambda df: df))
    report = jobs.clean_folder(spark, f"{base}/in", f"{base}/out", configs={"transactions": cfg})
    monkeypatch.undo()
    assert sum("FileScan csv" in p for p in plans) == 1
    assert sum("ArrowEvalPython" in p for p in plans) == 1
    found = {(r["step"], r["field"] or "", r["metric"]): r["value"] for r in report.collect()}
    assert (found["dedup", "", "kept"], found["dedup", "", "dropped"]) == (5, 55)
    assert (found["geo", "city", "resolved"], found["missing", "city", "imputed"], found["ratings", "rating", "changed"]) == (60, 20, 60)
    out = spark.read.option("header", True).csv(f"{base}/out/data/source_file=a.csv").collect()
    assert {r["id"]: r["city"] for r in out} == {"0": "Bengaluru", "1": "Pune", "2": "Bengaluru", "3": "Bengaluru", "4": "Pune"}
