"""The operators' named queries over the given tables, and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    containment, fingerprints, idfiles, lines, mixing, near, packing, periods, quality, repeats, secrets, trie,
    warc,
)
from ledgerloom.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CAPACITY = 2048


def query(key: str, sql: str | None = None):
    def register(plan):
        QUERIES[key] = plan
        if sql:
            ORACLES[key] = sql
        return plan

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_packing")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    parts = packing.pieces(docs, vocabulary("word_bpe_49k.json"), "dropped", CAPACITY)
    return packing.pack(parts, CAPACITY).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op2_near_dedup")
def op2(spark, sf_dir):
    return near.near_classes(table(spark, sf_dir, "documents")).drop("words_md5")


@query("op3_quality")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scores(docs, chain).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query(
    "op5_exact_dedup",
    """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
)
def op5(spark, sf_dir):
    return fingerprints.exact_groups(table(spark, sf_dir, "documents"))


#: containment of word shingles as nested loops over distinct shingles
CONTAINMENT_SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_split_to_array(trim(regexp_replace(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ') AS w
  FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_split_to_array(trim(regexp_replace(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ')
  FROM benchmark),
shingle AS (
  SELECT DISTINCT kind, id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM words),
size AS (SELECT id, count(*) AS n FROM shingle WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, any_value(size.n) AS n_shingles, count(*) AS n_found,
  count(*) / any_value(size.n) AS containment
FROM shingle d JOIN shingle i ON d.s = i.s AND d.kind = 'd' AND i.kind = 'i' JOIN size ON size.id = i.id
WHERE i.s <> '' GROUP BY d.id, i.id HAVING count(*) >= 0.8 * any_value(size.n)
"""


@query("op6_decontamination", CONTAINMENT_SQL)
def op6(spark, sf_dir):
    return containment.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_warc")
def op10(spark, sf_dir):
    archives, folder = warc.write_archives(table(spark, sf_dir, "pages"))
    members, folder = warc.normalise(archives, folder)
    return warc.read_records(members, folder)


@query("op7_substring_dedup")
def op7(spark, sf_dir):
    found = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


@query("op8_line_dedup")
def op8(spark, sf_dir):
    return lines.line_classes(table(spark, sf_dir, "documents"))


@query("op9_secrets")
def op9(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"), path_col="source")


@query("op4_token_files")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return idfiles.read_ids(*idfiles.write_ids(docs, vocabulary("byte_bpe_50k.json"), "opens"))


@query("op12_periods")
def op12(spark, sf_dir):
    found = periods.periodic_runs(table(spark, sf_dir, "documents"), change=periods.rebuilt)
    best = F.col("best")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periods.run_lines(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op11_mixing")
def op11(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op13_prefix_trie")
def op13(spark, sf_dir):
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))
