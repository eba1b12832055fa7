"""Exact duplicates by composable polynomial fingerprints.

A text's UTF-8 bytes are cut into chunks of fixed size. Each chunk ``c`` is hashed to
``h(c) = sum(c[i] * B**i) mod p`` for two primes below 2**31; chunks are hashed independently of
each other. Two neighbours combine by length-shifted arithmetic,
``h(ab) = h(a) + B**len(a) * h(b)``, so hashes of a huge document's chunks can be made anywhere
and summed in any order.

Documents with equal length and fingerprints are candidates only: their texts are compared chunk
by chunk with one document of the group, and whatever differs is grouped by its text itself.

Defined results: a null text counts as empty (all empty texts are equal). Repeated rows (also
with the same id) are members of their group like any other. Of rows that share the largest id
of a group, every one is marked ``kept``; ``distinct_rows`` of the pipeline leaves one. A null id
is smaller than any other. Other columns are not touched, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import keep

CHUNK = 1 << 16
#: the largest primes below 2**31, and a base for each
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525013)
#: members of one group that share a copy of the text they are compared with
SHARE = 512

_tables = []


def _chunk_hash(chunk: bytes) -> list[int]:
    if not _tables:
        for p, base in zip(PRIMES, BASES):
            # powers by doubling: the second half is the first times a constant
            table = np.ones(1, dtype=np.uint64)
            while len(table) < CHUNK:
                table = np.concatenate([table, table * np.uint64(pow(base, len(table), p)) % np.uint64(p)])
            _tables.append(table)
    data = np.frombuffer(chunk, dtype=np.uint8).astype(np.uint64)
    return [int(np.dot(data, t[: len(data)]) % np.uint64(p)) for t, p in zip(_tables, PRIMES)]


def chunk_hashes(chunks: Column) -> Column:
    """Hashes of an array of byte chunks, each chunk on its own."""

    @F.pandas_udf("array<array<bigint>>")
    def hashed(arrays: pd.Series) -> pd.Series:
        return arrays.map(lambda cs: [_chunk_hash(bytes(c)) for c in cs])

    return hashed(chunks)


def combine(left: list[int], left_bytes: int, right: list[int]) -> list[int]:
    """Fingerprint of a concatenation from those of its halves."""
    return [(a + pow(base, left_bytes, p) * b) % p for a, b, p, base in zip(left, right, PRIMES, BASES)]


def _combined(hashes: Column, i: int) -> Column:
    # h = h0 + S*(h1 + S*(h2 + ...)), S = B**CHUNK: from the last chunk to the first
    shift = pow(BASES[i], CHUNK, PRIMES[i])
    return F.aggregate(
        F.reverse(hashes), F.lit(0).cast("long"), lambda h, c: (h * F.lit(shift) + c[i]) % F.lit(PRIMES[i])
    )


def byte_chunks(text: Column, size: int = CHUNK) -> Column:
    """The UTF-8 bytes of a text in chunks; an empty text has one empty chunk."""
    body = F.encode(text, "UTF-8")
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(text) / F.lit(size))).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1), lambda k: F.substring(body, k * F.lit(size) + 1, F.lit(size))
    )


def with_fingerprint(docs: DataFrame, text: Column) -> DataFrame:
    """Add ``fp_bytes, fp_a, fp_b``."""
    hashes = docs.withColumn("fp_bytes", F.octet_length(text)).withColumn("fp_h", chunk_hashes(byte_chunks(text)))
    return hashes.withColumns({"fp_a": _combined(F.col("fp_h"), 0), "fp_b": _combined(F.col("fp_h"), 1)}).drop("fp_h")


KEY = ["fp_bytes", "fp_a", "fp_b"]


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    prints = keep(
        with_fingerprint(rows, F.col("body")).select(
            "id", *KEY, F.unhex(F.sha2(F.col("body").cast("binary"), 256)).alias("sha")
        ),
        "fingerprints",
    )
    # ids are compared as structs, so that a null id has a place too: it comes first
    groups = keep(
        prints.groupBy(*KEY)
        .agg(F.max(F.struct(F.col("id"))).alias("last"), F.count(F.lit(1)).alias("size"))
        .where("size > 1"),
        "groups",
    )
    odd = _unequal(rows, groups)
    by_print = prints.join(groups, KEY, "left").select(
        "id",
        *KEY,
        "sha",
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("last.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
    )
    if odd is not None:  # other texts under the same fingerprint: group those by their text
        by_print = _mend(by_print, odd)
    return by_print.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _unequal(rows: DataFrame, groups: DataFrame) -> DataFrame | None:
    """All rows of groups in which some text differs from the others; None when there are none."""
    members = keep(
        with_fingerprint(rows, F.col("body"))
        .join(groups, KEY)
        .select(
            "id",
            "body",
            *KEY,
            "size",
            F.col("id").eqNullSafe(F.col("last.id")).alias("is_last"),
            (F.abs(F.xxhash64("id")) % F.ceil(F.col("size") / SHARE)).alias("share"),
        ),
        "members",
    )
    # one row per group is enough to compare with, also where its id is repeated
    one = members.where("is_last").groupBy(*KEY).agg(F.min("body").alias("body"), F.first("size").alias("size"))
    model = one.select(
        *KEY,
        F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / SHARE) - 1)).alias("share"),
        byte_chunks(F.col("body")).alias("model"),
    )
    compared = members.join(model, [*KEY, "share"])
    # arrays compare element by element: chunk after chunk, up to the first difference
    wrong = keep(compared.where(F.col("model") != byte_chunks(F.col("body"))).select(*KEY).distinct(), "unequal")
    return members.join(wrong, KEY, "left_semi").select("id", "body", *KEY) if wrong.take(1) else None


def _mend(by_print: DataFrame, odd: DataFrame) -> DataFrame:
    fixed = odd.groupBy("body").agg(F.max(F.struct("id")).alias("last"), F.count(F.lit(1)).alias("n"))
    fixed = odd.join(fixed, "body").select(
        "id",
        *KEY,
        F.unhex(F.sha2(F.col("body").cast("binary"), 256)).alias("sha"),
        F.col("last.id").alias("keep_id"),
        F.col("n").alias("group_size"),
    )
    return by_print.join(odd.select(*KEY).distinct(), KEY, "left_anti").unionByName(fixed)
