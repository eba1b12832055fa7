"""From raw documents to packed training sequences: five stages, each a distributed operator.

Every stage takes all rows that its predecessor kept and returns the columns of ``documents``,
but for the last, which returns the packed pieces. Rows are written as Parquet between stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import stages
from ledgerloom.llm.store import keep

STAGES = [
    ("quality", stages.good_quality),
    ("exact_dedup", stages.distinct_texts),
    ("near_dedup", stages.distinct_near),
    ("decontamination", stages.without_benchmark),
    ("packing", stages.packed),
]

#: a learned classifier, sampled minima and packing are not SQL; tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
