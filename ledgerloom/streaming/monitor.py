"""Month-to-date monitor kept up to date from a stream of sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.revenue import against_target


def file_stream(spark: SparkSession, folder: str, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Parquet that appears under ``folder`` as a stream: files, or tables that are folders of part files.

    The schema is that of what is there now.
    """
    # a stream takes a path without wildcards for a folder; a one-letter class makes any name a pattern
    path = f"{folder.rstrip('/')}/{pattern[:-1]}[{pattern[-1]}]"
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return stream.parquet(path)


def utc_instant(c: Column) -> Column:
    """A time without zone as the instant with the same clock time in UTC; watermarks need an instant."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, c.cast("timestamp_ntz")))


DAYS = "customer_id string, revenue decimal(28,2), orders bigint, batch bigint, date date"


def daily_by_customer(sales: DataFrame) -> DataFrame:
    """Revenue and orders per UTC day and customer from (ts, customer_id, revenue).

    The customer stays in the key: distinct customers of a month are then exact, and a busy
    day is spread over the partitions.
    """
    day = F.date_from_unix_date(F.floor(F.unix_seconds("ts") / 86400).cast("int"))
    return sales.groupBy(day.alias("date"), "customer_id").agg(
        F.sum("revenue").cast("decimal(28,2)").alias("revenue"), F.count(F.lit(1)).alias("orders"))


def start_monitor(sales: DataFrame, table: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the sums of every batch, by day.

    A batch writes a folder of its own and overwrites it when replayed, so a restart after a
    failure counts nothing twice. Sums of different batches are added up by the reader: a sale
    counts however late it comes, and no state is held. Without ``every`` the query reads what is
    there and stops.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        daily_by_customer(batch).write.mode("overwrite").partitionBy("date").parquet(f"{table}/batch={batch_id}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return sales.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def current_days(spark: SparkSession, table: str) -> DataFrame:
    """Sums of each day and customer over all batches; a filter on ``date`` reaches the folders."""
    parts = spark.read.schema(DAYS).parquet(table)
    return parts.groupBy("date", "customer_id").agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))


def daily_revenue(spark: SparkSession, table: str, year: int, month: int) -> DataFrame:
    first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    days = current_days(spark, table).filter(F.col("date").between(first, F.last_day(first)))
    return days.groupBy("date").agg(F.sum("revenue").alias("revenue"))


def month_to_date(spark: SparkSession, table: str, as_of: str, target: float) -> DataFrame:
    days = current_days(spark, table).filter(
        F.col("date").between(F.lit(as_of[:8] + "01").cast("date"), F.lit(as_of).cast("date")))
    totals = days.agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).cast("double").alias("revenue"),
        F.count_distinct("customer_id").alias("customers"), F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"))
    return against_target(totals, as_of, target)
