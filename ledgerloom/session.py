"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC dates.

    Shuffle partitions are left to the cluster's own setting; adaptive execution
    merges small ones and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # no Python stack capture per column call: building a wide plan is several times faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


#: rows of one task of a sorted join, about
ROWS_PER_PART = 500_000

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per application: they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-"), "ledgerloom")
        spark.sparkContext.addPyFile(shutil.make_archive(target, "zip", root, "ledgerloom"))
        _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session that
    names none gets a temporary folder of its own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="ledgerloom-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` shuffled by ``keys`` into as many parts as ``rows`` rows ask for, where the session's own number is too small.

    So what a task sorts does not grow with the input. Both sides of a join take the same ``rows``.
    """
    n = -(-rows // ROWS_PER_PART)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions") or 200) else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it from there.

    Several branches can then use it, each reading only its columns, and a lost executor
    costs no recomputation of what lies before.
    """
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
