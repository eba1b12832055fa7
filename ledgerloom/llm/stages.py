"""The stages of the corpus pipeline; each takes ``(spark, docs, sf_dir)``.

All but the last return the columns of ``docs``, whatever there are; rows stay as they are.

* ``good_quality`` drops documents that the classifier scores below its threshold.
* ``distinct_texts`` keeps, of equal texts, one row with the largest id.
* ``distinct_near`` keeps one row of each class of near duplicates, the one with the smallest id.
* ``without_benchmark`` drops documents that contain an item of ``benchmark``.
* ``packed`` cuts and packs the token ids of what is left.

A null id is an id like any other: such rows stand together. Of rows that agree in id and text
one stays; a null text counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import containment, fingerprints, near, packing, quality
from ledgerloom.llm.queries import CAPACITY, table, vocabulary
from ledgerloom.llm.store import keep


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # learned from the table that the labels belong to, whatever this stage is given to judge
    chain = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = quality.scores(docs.select(F.struct("*").alias("row")), chain, "row.text")
    return scored.where(F.col("score") >= quality.THRESHOLD).select("row.*")


def _staying(docs: DataFrame, stays: DataFrame, mark: Column) -> DataFrame:
    """Rows of ``docs`` whose id and mark are in ``stays`` (``chosen, chosen_mark``, one row per row that may stay)."""
    stays = keep(stays.groupBy("chosen", "chosen_mark").agg(F.count(F.lit(1)).alias("times")), "stays")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own"), mark.alias("own_mark"))
    same = F.col("own").eqNullSafe(F.col("chosen")) & (F.col("own_mark") == F.col("chosen_mark"))
    kept = rows.join(stays, same, "left_semi")
    if stays.where("times > 1").take(1):  # repeated rows; texts go through this further shuffle only then
        kept = kept.dropDuplicates(["own", "own_mark"])
    return kept.select("row.*")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stays = fingerprints.exact_groups(docs).where("kept")
    return _staying(
        docs,
        stays.select(F.col("doc_id").alias("chosen"), F.unhex("text_sha256").alias("chosen_mark")),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)),
    )


def distinct_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stays = near.near_classes(docs).where("kept")
    return _staying(
        docs,
        stays.select(F.col("doc_id").alias("chosen"), F.col("words_md5").alias("chosen_mark")),
        F.unhex(F.md5(near.plain(F.col("text")))),
    )


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = containment.contained(docs, table(spark, sf_dir, "benchmark"))
    leaks = found.select(F.col("doc_id").alias("leak")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own"))
    return rows.join(leaks, F.col("own").eqNullSafe(F.col("leak")), "left_anti").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    parts = packing.pieces(docs.select("doc_id", "text"), vocabulary("word_bpe_49k.json"), "dropped", CAPACITY)
    return packing.pack(parts, CAPACITY).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
