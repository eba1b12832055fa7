"""Whole jobs: clean a folder of CSVs, and load cleaned folders into the star schema."""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom import presets
from ledgerloom.config import CleaningConfig
from ledgerloom.operators import warehouse as wh
from ledgerloom.operators.cleaning import run_cleaning
from ledgerloom.sources import files

CONFIGS = {"transactions": presets.TRANSACTIONS, "catalog": presets.CATALOG}


def clean_file(spark: SparkSession, path: str, cfg: CleaningConfig, out_folder: str,
               casts: dict[str, str] | None = None) -> DataFrame:
    """Clean one CSV and write it with its report; returns the report as written."""
    report = None
    for rows, holes in typed_tables(spark, [path], casts, multi_line=True):
        report = write_run(rows, cfg, "single", out_folder, holes)
    return report


def clean_folder(spark: SparkSession, folder: str, out_folder: str, overwrite: bool = False,
                 configs: dict[str, CleaningConfig] | None = None, casts: dict[str, str] | None = None,
                 multi_line: bool = True) -> DataFrame | None:
    """Clean every new CSV of a folder: one run per configuration, header and column types, statistics per file.

    With ``multi_line`` a quoted value may hold line breaks; without, huge files can be split.
    """
    configs = configs or CONFIGS
    routed = files.route_files(spark, folder, out_folder, overwrite).collect()
    report = None
    for name, cfg in configs.items():
        chosen = [row.path for row in routed if row.config == name]
        for rows, holes in typed_tables(spark, chosen, casts, multi_line) if chosen else ():
            report = write_run(rows, cfg, name, out_folder, holes)
    return report


def typed_tables(spark: SparkSession, paths: list[str], casts: dict[str, str] | None, multi_line: bool):
    """Tables to be cleaned, with their columns that hold a null where those are known: a caller's casts may add some."""
    if casts:
        return [(rows, None) for rows in files.scan_groups(spark, paths, casts, multi_line, types=True)]
    return files.stored_groups(spark, paths, multi_line)


def write_run(rows: DataFrame, cfg: CleaningConfig, config_name: str, out_folder: str, holes: list[str] | None = None) -> DataFrame:
    cleaned, report = run_cleaning(rows, cfg, by=["source_file"], holes=holes)
    labelled = report.withColumnRenamed("source_file", "file").withColumn("config", F.lit(config_name))
    files.write_clean(cleaned, labelled, out_folder)
    return rows.sparkSession.read.json(f"{out_folder}/report")


PRODUCTS = ("product_id string, product_name string, brand string, category string, subcategory string, "
            "launch_year int, base_price_2015 decimal(18,2), weight_kg decimal(12,3)")
CUSTOMERS = ("customer_id string, customer_name string, age_group string, city string, state string, "
             "is_prime_member boolean, segment string, signup_date date")


def typed_catalog(rows: DataFrame) -> DataFrame:
    kinds = {"launch_year": "double", "base_price_2015": "decimal(18,2)", "weight_kg": "decimal(12,3)"}
    typed = rows.withColumns({c: F.col(c).try_cast(k) for c, k in kinds.items() if c in rows.columns})
    return typed.withColumn("launch_year", F.col("launch_year").cast("int")) if "launch_year" in rows.columns else typed


def current_run(spark: SparkSession, warehouse: str) -> str | None:
    """Name of the last run that finished, from the pointer it left."""
    try:
        return spark.read.schema("run string").json(f"{warehouse}/current").first()["run"]
    except AnalysisException:
        return None


def load_folder(spark: SparkSession, cleaned_folder: str, warehouse: str, calendar_start="2015-01-01",
                calendar_end="2025-12-31", multi_line: bool = True, refuse_unknown_keys: bool = False) -> dict[str, DataFrame]:
    """Star schema from cleaned CSVs: calendar, products, customers and the fact.

    Files without a date or revenue column add no facts; files named as catalogs add
    products. New dimension rows are merged with those of the last finished run; what is known of a
    customer stays, a product's values are replaced by new ones that are not null. The calendar
    covers the given days and every day of the fact. Dimensions go to a new folder per run and a
    pointer is moved at the end, so a failed run leaves the earlier tables as they were. Keys of the
    fact that a dimension lacks are written as ``key_report``, and can be refused.
    """
    paths = [row.path for row in files.list_csv(spark, cleaned_folder).collect()]
    groups = files.scan_groups(spark, paths, multi_line=multi_line)
    order = F.struct("_src", "_row")
    facts = people = None
    earlier = current_run(spark, warehouse)

    def before(name: str, schema: str) -> DataFrame:
        return spark.read.parquet(f"{warehouse}/{name}-{earlier}") if earlier else spark.createDataFrame([], schema)

    goods = before("products", PRODUCTS)
    for rows in groups:
        catalogs = rows.filter(F.lower("source_file").contains("catalog"))
        if "product_id" in rows.columns:
            goods = wh.upsert_products(goods, typed_catalog(catalogs), order)
        part = wh.normalize_fact(rows, F.col("source_file"))
        if part is None:
            continue
        buyers = wh.pick_columns(rows, keep=["_src", "_row"]).withColumn("is_prime_member", wh.boolean(F.col("is_prime_member")))
        buyers = buyers.select("customer_id", "city", "state", "is_prime_member", "_src", "_row")
        facts = part if facts is None else facts.unionByName(part)
        people = buyers if people is None else people.unionByName(buyers)
    if facts is None:
        raise ValueError("no file has both a date and a revenue column")
    wh.append_fact(facts, f"{warehouse}/transactions")
    loaded = spark.read.parquet(f"{warehouse}/transactions")
    run = uuid4().hex
    days = loaded.agg(F.min("order_date").cast("string").alias("a"), F.max("order_date").cast("string").alias("b")).first()
    tables = {
        "time_dimension": wh.time_dimension(
            spark, min(calendar_start, days["a"] or calendar_start), max(calendar_end, days["b"] or calendar_end)),
        "products": wh.upsert_product_ids(goods, loaded),
        "customers": wh.upsert_customers(before("customers", CUSTOMERS), people, order),
    }
    out = {"transactions": loaded}

    def put(name: str, df: DataFrame) -> None:
        path = f"{warehouse}/{name}-{run}"
        df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.parquet(path)

    for name, df in tables.items():
        put(name, df)
    put("key_report", wh.fk_violations(loaded, out["time_dimension"], out["customers"], out["products"]))
    if refuse_unknown_keys and out["key_report"].take(1):
        raise ValueError(f"the fact has keys that its dimensions lack; see {warehouse}/key_report-{run}")
    spark.createDataFrame([(run,)], "run string").coalesce(1).write.mode("overwrite").json(f"{warehouse}/current")
    return out
