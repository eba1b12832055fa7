"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items and documents are sets of shingles of five words (lower-cased, between ASCII characters
other than letters and digits; a text of one to four words is one shingle). Item ``q`` is in
document ``d`` when ``|q & d| / |q|`` is ``CONTAINED`` or more.

MinHash finds sets of similar size, and an item is much shorter than a document. So items are
partitioned by size into classes ``(u/2, u]``, ``u`` a power of two times 8, and for every class
that occurs the documents are covered by overlapping windows of ``2u`` shingles, ``u`` apart: an
item's passage lies in one window as a whole. Within a class the Jaccard index of an item and its
window is then at least ``0.8/(2*2 + 0.2)``, about 0.19, however long the document is, and
``HASHES`` minima miss it with a probability below 1 in 10,000. The first class, of one to ``BLOCK``
shingles, has no lower end, so there every distinct shingle is a key, of items and documents: an item
that is contained shares one at least. Minima of wide windows are minima
of narrow ones, so each shingle is hashed once per function.

Only minima that some item has can match. A bitmap of ``2**BITS`` places, whose size does not
depend on any table, goes to all tasks and drops nearly all others before the join. Shingles of
documents with a match are looked up in a second bitmap and carried as text; candidates are
decided by counting distinct equal shingle texts.

Defined results: items without words are found nowhere; a null text has no words. Repeated rows of
documents or items are searched like any other and give a pair each. Null ids appear as null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import keep
from ledgerloom.llm.words import mix, plain_words, shingles

WORDS = 5
CONTAINED = 0.8
BLOCK = 8
HASHES = 48
BITS = 24
_PART = 1 << 13

_rng = np.random.default_rng(71_993)
_FACTORS = _rng.integers(0, 1 << 63, size=HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MARKS = mix(_rng.integers(0, 1 << 63, size=(64, HASHES), dtype=np.uint64))


def size_class(n: int) -> int:
    """Smallest ``c`` with ``n <= BLOCK * 2**c``."""
    return max(0, int(-(-n // BLOCK) - 1).bit_length())


def minima(hashes: np.ndarray, every: int = 0) -> np.ndarray:
    """Minimum of every hash function over all shingles, or over each run of ``every``."""
    parts = []
    for at in range(0, len(hashes), _PART):
        hashed = hashes[None, at : at + _PART] * _FACTORS[:, None]
        cuts = np.arange(0, hashed.shape[1], every) if every else np.zeros(1, dtype=np.int64)
        parts.append(np.minimum.reduceat(hashed, cuts, axis=1))
    together = np.concatenate(parts, axis=1)
    return together if every else together.min(axis=1, keepdims=True)


def keys(low: np.ndarray, size: int) -> np.ndarray:
    """What is compared: a minimum with its function and size class."""
    return mix(low ^ _MARKS[size][:, None])


def own_keys(hashes: np.ndarray, size: int) -> np.ndarray:
    """What an item of a class is found by: all its shingles in the first class, minima in others."""
    return mix(hashes ^ _MARKS[0][0]) if size == 0 else keys(minima(hashes), size).ravel()


def window_keys(hashes: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Distinct keys of all windows of a text for the given classes (ascending)."""
    found = []
    low, at = minima(hashes, BLOCK), 0
    for size in sizes:
        while at < size:
            low, at = np.minimum.reduceat(low, np.arange(0, low.shape[1], 2), axis=1), at + 1
        windows = np.minimum(low[:, :-1], low[:, 1:]) if low.shape[1] > 1 else low
        found.append(keys(windows, size).ravel())
    return np.concatenate(found)


def document_keys(hashes: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Keys by which items of the given classes are found in a text."""
    wide = [size for size in sizes if size]
    exact = [own_keys(hashes, 0)] if 0 in sizes else []
    return np.concatenate(exact + ([window_keys(hashes, wide)] if wide else []))


def _shingle_text(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, i: int) -> str:
    return " ".join(data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts[i : i + WORDS], ends[i : i + WORDS]))


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per item its number, id, class, keys and distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text in enumerate(batch.column("body")):
                data, starts, ends, words = plain_words(text.as_py())
                if not len(words):
                    continue
                hashes, first = np.unique(shingles(words, WORDS), return_index=True)
                texts = sorted({_shingle_text(data, starts, ends, j) for j in first.tolist()})
                size = size_class(len(hashes))
                rows.append((i, size, own_keys(hashes, size).view(np.int64), hashes.view(np.int64), texts))
            row, size, found_by, hashes, texts = zip(*rows) if rows else [()] * 5
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "item": batch.column("item").take(row),
                "own": batch.column("own").take(row),
                "size": pa.array(size, pa.int32()),
                "keys": pa.array(found_by, pa.list_(pa.int64())),
                "hashes": pa.array(hashes, pa.list_(pa.int64())),
                "texts": pa.array(texts, pa.list_(pa.string())),
            })

    rows = items.select(
        F.monotonically_increasing_id().alias("item"), F.col(id_col).cast("long").alias("own"), F.col(text_col).alias("body")
    )
    return rows.mapInArrow(
        run, "item bigint, own bigint, size int, keys array<bigint>, hashes array<bigint>, texts array<string>"
    )


def _bitmap(values: DataFrame, column: str) -> np.ndarray:
    """Places of the values' upper bits; at most ``2**BITS / 64`` rows come to the driver, however many values."""
    place = F.shiftrightunsigned(F.col(column), 64 - BITS)
    words = (
        values.select(F.shiftright(place, 6).cast("int").alias("word"), (place % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))
        .toPandas()
    )
    out = np.zeros(1 << (BITS - 6), dtype=np.int64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return out


def _marked(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = (values >> np.uint64(64 - BITS)).astype(np.int64)
    return (bitmap[place >> 6] >> (place & 63)) & 1 == 1


def _search(docs: DataFrame, sizes: list[int], wanted_keys, wanted_shingles, id_col: str, text_col: str) -> DataFrame:
    """Matches of documents: keys that may be an item's, and shingle texts that may be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, shared = wanted_keys.value, wanted_shingles.value
        for batch in batches:
            row, found_keys, found_texts = [], [], []
            for i, text in enumerate(batch.column("body")):
                data, starts, ends, words = plain_words(text.as_py())
                if not len(words):
                    continue
                hashes = shingles(words, WORDS)
                found = document_keys(hashes, sizes)
                found = np.unique(found[_marked(have, found)]).view(np.int64).tolist()
                if not found:
                    continue
                hits = np.flatnonzero(_marked(shared, hashes)).tolist()
                texts = list({_shingle_text(data, starts, ends, j) for j in hits})
                row += [i] * (len(found) + len(texts))
                found_keys += found + [None] * len(texts)
                found_texts += [None] * len(found) + texts
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "doc": batch.column("doc").take(row),
                "own": batch.column("own").take(row),
                "key": pa.array(found_keys, pa.int64()),
                "shingle": pa.array(found_texts, pa.string()),
            })

    rows = docs.select(
        F.monotonically_increasing_id().alias("doc"), F.col(id_col).cast("long").alias("own"), F.col(text_col).alias("body")
    )
    return rows.mapInArrow(run, "doc bigint, own bigint, key bigint, shingle string")


def contained(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """Pairs ``doc_id, item_id, n_shingles, n_found, containment`` of items that are in documents."""
    spark = docs.sparkSession
    known = keep(_items(items, "item_id", text_col), "items")
    sizes = sorted(r["size"] for r in known.select("size").distinct().collect())  # logarithmic in the longest item
    send = spark.sparkContext.broadcast
    have = send(_bitmap(known.select(F.explode("keys").alias("k")), "k"))
    shared = send(_bitmap(known.select(F.explode("hashes").alias("k")), "k"))
    if not sizes:
        docs = docs.limit(0)
    matches = keep(_search(docs, sizes or [0], have, shared, "doc_id", text_col), "matches")
    item_keys = known.select("item", F.explode("keys").alias("key"))
    candidates = matches.where("key is not null").join(item_keys, "key").select("doc", "item").distinct()
    item_shingles = known.select("item", F.explode("texts").alias("shingle"))
    found = (
        matches.where("shingle is not null")
        .join(item_shingles, "shingle")
        .groupBy("doc", "own", "item")
        .agg(F.count(F.lit(1)).alias("n_found"))
    )
    total = known.select("item", F.col("own").alias("item_id"), F.size("texts").cast("long").alias("n_shingles"))
    return (
        found.join(candidates, ["doc", "item"], "left_semi")
        .join(total, "item")
        .where(F.col("n_found") >= F.lit(CONTAINED) * F.col("n_shingles"))
        .select(
            F.col("own").alias("doc_id"),
            "item_id",
            "n_shingles",
            "n_found",
            (F.col("n_found") / F.col("n_shingles")).alias("containment"),
        )
    )
