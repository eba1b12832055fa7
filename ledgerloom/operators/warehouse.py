"""Star-schema operators: calendar, column picking, dimension merges, fact load and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions.dates import date_key, key_of, parse_iso
from ledgerloom.functions.parsing import boolean
from ledgerloom.presets import CATALOG_COLUMNS, LOADER_COLUMNS

# Column types of the fact table.
FACT_TYPES = {
    "order_id": "string", "date_key": "int", "order_date": "date", "customer_id": "string", "product_id": "string",
    "quantity": "decimal(18,3)", "unit_price": "decimal(18,2)", "revenue": "decimal(18,2)",
    "category": "string", "brand": "string", "payment_method": "string", "city": "string", "state": "string",
    "is_prime_member": "boolean", "delivery_days": "int", "customer_rating": "decimal(5,2)",
    "discount_pct": "decimal(5,2)", "is_returned": "boolean", "source_file": "string",
}


def time_dimension(spark: SparkSession, start: str, end: str, fiscal_start: int = 4) -> DataFrame:
    """One row per day from ``start`` to ``end`` with calendar and fiscal attributes."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))
    return days.selectExpr(
        "year(date) * 10000 + month(date) * 100 + day(date) as date_key", "date",
        "day(date) as day", "month(date) as month", "date_format(date, 'MMMM') as month_name",
        "quarter(date) as quarter", "concat('Q', quarter(date)) as quarter_name", "year(date) as year",
        "weekofyear(date) as week_iso", "date_format(date, 'EEEE') as day_name", "weekday(date) >= 5 as is_weekend",
        f"if(month(date) >= {fiscal_start}, year(date), year(date) - 1) as fiscal_year",
        f"cast(floor(pmod(month(date) - {fiscal_start}, 12) / 3) + 1 as int) as fiscal_quarter",
    )


def merge_calendar(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Replace the days that come in, keep the others."""
    return existing.join(incoming, "date_key", "left_anti").unionByName(incoming)


def pick(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    return next((c for c in candidates if c in columns), None)


def picked_names(df: DataFrame, candidates: dict[str, list[str]] = LOADER_COLUMNS) -> dict[str, str | None]:
    return {field: pick(df.columns, names) for field, names in candidates.items()}


def pick_columns(df: DataFrame, candidates: dict[str, list[str]] = LOADER_COLUMNS,
                 required: Sequence[str] = ("order_date", "revenue"), keep: Sequence[str] = ()) -> DataFrame | None:
    """Project to logical field names; ``None`` when a required field has no column."""
    names = picked_names(df, candidates)
    if any(names[r] is None for r in required):
        return None
    return df.select(*[
        (F.col(f"`{n}`") if n else F.lit(None).cast("string")).alias(field) for field, n in names.items()
    ], *keep)


def normalize_fact(df: DataFrame, source_file: Column, candidates: dict[str, list[str]] = LOADER_COLUMNS) -> DataFrame | None:
    """Text columns to the fact's types; unreadable values become null."""
    names = picked_names(df, candidates)
    # rows of a scanned file carry their place, which identifies and orders them
    placed = [c for c in ("_src", "_row") if c in df.columns]
    picked = pick_columns(df.withColumn("source_file", source_file), candidates, keep=["source_file", *placed])
    if picked is None:
        return None
    day = parse_iso(F.col("order_date").cast("string"))
    position = [
        F.struct("source_file", "_src", "_row").alias("tx_id"),
        F.struct("source_file", "_src", F.col("_row.start").alias("start"), F.shiftright("_row.n", 12).alias("n")).alias("tx_slice"),
    ] if len(placed) == 2 else []
    whole_days = F.col("delivery_days").cast("string").try_cast("decimal(20,4)")
    special = {
        "order_date": day,
        "date_key": date_key(day),
        "quantity": F.col("quantity").cast("string").try_cast("decimal(18,3)") if names["quantity"] else F.lit(1).cast("decimal(18,3)"),
        "delivery_days": F.when(whole_days == F.floor(whole_days), whole_days.try_cast("int")),
        "is_prime_member": boolean(F.col("is_prime_member")),
        "is_returned": boolean(F.col("is_returned")),
    }
    return picked.select(*[
        special.get(c, F.col(c).cast("string").try_cast(kind) if kind.startswith("decimal") else F.col(c).cast(kind)).alias(c)
        for c, kind in FACT_TYPES.items() if c in special or c in picked.columns
    ], *position)


def first_rows(df: DataFrame, keys: Sequence[str], order: Column, sums: Sequence[Column] = ()) -> DataFrame:
    """First row of each key by ``order``; null keys are equal to each other. ``sums`` are
    aggregates that take the place of their columns.

    An aggregate rather than a window: partial aggregation shrinks a group of copies
    before it is shuffled, however large the group is.
    """
    summed = [c for c in df.columns if c.startswith("_flag_")] if sums else []
    rest = [c for c in df.columns if c not in keys and c not in summed]
    if not rest:
        return df.groupBy(*keys).agg(*sums) if sums else df.select(*keys).distinct()
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_first"), *sums)
    return first.select(*[F.col(f"_first.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def insert_unseen(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Add incoming rows whose key is new; columns that do not come in are null."""
    fresh = incoming.join(existing.select(key), key, "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)


def upsert_product_ids(existing: DataFrame, facts: DataFrame) -> DataFrame:
    ids = facts.filter(F.col("product_id").isNotNull()).select("product_id").distinct()
    return insert_unseen(existing, ids, "product_id")


def upsert_customers(existing: DataFrame, facts: DataFrame, order: Column) -> DataFrame:
    """Insert unseen customers with the city, state and prime flag of their first row."""
    seen = facts.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.min_by(F.struct("city", "state", "is_prime_member"), order).alias("_f"))
    return insert_unseen(existing, seen.select("customer_id", "_f.*"), "customer_id")


def upsert_products(existing: DataFrame, catalog: DataFrame, order: Column) -> DataFrame:
    """Catalog load: first row per id, new values win unless they are null."""
    if "sub_category" in catalog.columns and "subcategory" not in catalog.columns:
        catalog = catalog.withColumnRenamed("sub_category", "subcategory")
    present = [c for c in CATALOG_COLUMNS if c in catalog.columns]
    if "product_id" not in present:
        raise ValueError("a catalog needs a product_id column")
    keyed = catalog.filter(F.col("product_id").isNotNull()).withColumn("_order", order)
    fresh = first_rows(keyed.select(*present, "_order"), ["product_id"], F.col("_order")).drop("_order")
    both = existing.alias("old").join(fresh.alias("new"), "product_id", "full_outer")
    columns = [*existing.columns, *[c for c in present if c not in existing.columns]]

    def merged(c: str) -> Column:
        if c == "product_id":
            return F.col(c)
        sides = [F.col(f"new.{c}")] if c in present else []
        sides += [F.col(f"old.{c}")] if c in existing.columns else []
        return F.coalesce(*sides).alias(c)

    return both.select(*[merged(c) for c in columns])


def append_fact(facts: DataFrame, path: str) -> None:
    """Write the fact one folder per source file, by days inside it. Loading a file again replaces its folder.

    Rows are dealt by ranges of file and day and sorted, so a part file holds few days and every row
    group's smallest and largest day tell a report over a month which ones to skip. A hash behind the day lets
    a day of any size be split.
    """
    spread = F.xxhash64(*[c for c in FACT_TYPES if c in facts.columns])
    placed = facts.repartitionByRange("source_file", "order_date", spread).sortWithinPartitions("source_file", "order_date")
    (placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source_file").parquet(path))


def evolve_fact(df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Add the category and brand columns where an older fact lacks them."""
    wanted = columns or {"category": "string", "brand": "string"}
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in wanted.items() if c not in df.columns])


def missing_keys(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows per key that the dimension lacks, counted before the join so that a hot key is one row."""
    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = counts.join(dimension.select(key), key, "left_anti")
    return missing.select(F.lit(key).alias("fk"), F.col(key).cast("string").alias("key"), "n")


def fk_violations(facts: DataFrame, calendar: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    return (
        missing_keys(facts, calendar, "date_key")
        .unionByName(missing_keys(facts, customers, "customer_id"))
        .unionByName(missing_keys(facts, products, "product_id"))
    )


def in_range(facts: DataFrame, calendar: DataFrame, start: str | None = None, end: str | None = None,
             attrs: Sequence[str] = ()) -> DataFrame:
    """Fact rows whose day the calendar holds, within [start, end], plus calendar attributes.

    The range is also put on the fact's own date columns, where it reaches the scan. The
    calendar has one row per day, so broadcasting it is safe at any fact size.
    """
    if start is not None and end is not None:
        facts = facts.filter(F.col("date_key").between(key_of(start), key_of(end)))
        if "order_date" in facts.columns:
            facts = facts.filter(F.col("order_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        calendar = calendar.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return facts.join(F.broadcast(calendar.select("date_key", *attrs)), "date_key")


NULL_PLACES = 1024


def look_up(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join on ``key``, of which ``dimension`` has one row each. Rows without a key meet nothing, and not in one task.

    They are dealt over ``NULL_PLACES`` places of their own instead of all going where null hashes to. A frequent
    key needs no more than that: the join is a plain one, whose large partitions adaptive execution splits.
    """
    known = F.col(key).isNotNull()
    others = [f.name for f in df.schema.fields if f.name != key and not f.dataType.typeName() == "map"]
    place = F.when(known, 0).otherwise(1 + F.pmod(F.xxhash64(*others) if others else F.lit(0), F.lit(NULL_PLACES))).cast("int")
    empty = F.lit("").cast(df.schema[key].dataType) if df.schema[key].dataType.typeName() == "string" else F.lit(0).cast(df.schema[key].dataType)
    left = df.withColumns({"_place_of": place, "_key_of": F.coalesce(key, empty)})
    right = dimension.filter(known).withColumns({"_place_of": F.lit(0), "_key_of": F.col(key)}).drop(key)
    return left.join(right, ["_key_of", "_place_of"], "left").drop("_key_of", "_place_of")


def label_products(df: DataFrame, products: DataFrame, *labels: str, own: bool = True, extra: Sequence[str] = ()) -> DataFrame:
    """Category or brand from the product, else (``own``) from the row, else 'Unknown'."""
    dim = products.select(F.col("product_id"), *[F.col(c).alias(f"_p_{c}") for c in labels], *extra)
    joined = look_up(df, dim, "product_id")

    def label(c: str) -> Column:
        sources = [F.col(f"_p_{c}")] + ([F.col(c)] if own and c in df.columns else [])
        return F.coalesce(*sources, F.lit("Unknown"))

    out = joined.withColumns({f"_l_{c}": label(c) for c in labels}).drop(*labels, *[f"_p_{c}" for c in labels])
    return out.withColumnsRenamed({f"_l_{c}": c for c in labels})


def star_view(facts: DataFrame, calendar: DataFrame, products: DataFrame, customers: DataFrame,
              start: str | None = None, end: str | None = None,
              attrs: Sequence[str] = ("date", "year", "quarter", "month")) -> DataFrame:
    """The row-level join behind the reports. Dimensions other than the calendar are
    broadcast only when Spark finds them below its size threshold."""
    rows = label_products(in_range(facts, calendar, start, end, attrs), products, "category", "brand")
    people = customers.select("customer_id", "age_group", F.col("is_prime_member").alias("_prime"))
    return (
        look_up(rows, people, "customer_id")
        .withColumn("prime", F.coalesce("is_prime_member", "_prime"))
        .drop("_prime", "is_prime_member")
    )
