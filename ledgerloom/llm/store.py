"""Intermediate tables and binary files in the folder that the whole cluster shares."""

from __future__ import annotations

import gc
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import shared_folder, ship_package


def new_folder(spark: SparkSession, what: str) -> str:
    ship_package(spark)
    return f"{shared_folder(spark).rstrip('/')}/{what}-{uuid4().hex}"


def keep(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once and read it from there: branches share it, a lost executor redoes none of it."""
    path = new_folder(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that only finished work had used.

    It does so when the driver collects its garbage, which a driver with little to do rarely does.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def open_folder(uri: str):
    """The file system and the path in it of a shared folder; usable in tasks."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + uri
    elif uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)
