"""Repeated passages by seed and extend on winnowed anchors.

Words are runs of bytes other than space and the control characters 9 to 13, unchanged. A window
is ``WINDOW`` consecutive words. Each window selects one anchor: the smallest-hashed run of
``SEED`` words in it, the rightmost of equal ones. Equal windows select equal anchors, so every
repeat of ``WINDOW`` words or more is seeded, by about a fifth of all positions.

1. Seeds: anchors that occur under more than one document id, by a minimum and a maximum per
   anchor. Everything else is unique and needs no further look.
2. Extend: around each shared anchor the run of windows that select it is taken, as far as it
   goes in both directions: its extent. Occurrences with equal extents are one class, known by
   its smallest document. Where an anchor has several classes (at the ends of a repeat), their
   windows are compared one by one.
3. A window is a repeat if its class, or another class of the anchor that has the window, occurs
   in a document with a smaller id. Overlapping repeated windows merge into maximal repeats.

No pair of occurrences is ever formed: groups are reduced to minima before and after each shuffle,
so a passage in a third of all documents costs what any other text costs. Where occurrences look
up their anchor or class, those of frequent ones are dealt over parts (``_join_split``).

Windows count as equal when the hash of their 13 words and that of their anchor agree (128 bits).

Defined results: a null or empty text has no words. Words are judged on the input alone. Rows
with equal ids are not before each other. A null id is larger than any other, and so are two of
them equal. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import free, keep
from ledgerloom.llm.words import WHITE, as_bytes, run_hashes, spans, word_hashes

WINDOW = 13
SEED = 5
_LAST = (1 << 63) - 1

#: a key with more than one in HOT of all rows is dealt over PARTS parts
HOT = 1000
PARTS = 64


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and position of each anchor, and first and last window that select it."""
    seeds = run_hashes(words, SEED)
    span = WINDOW - SEED + 1
    if len(seeds) < span:
        none = np.empty(0, dtype=np.int64)
        return seeds[:0], none, none, none
    view = np.lib.stride_tricks.sliding_window_view(seeds, span)[:, ::-1]
    chosen = np.arange(len(view)) + span - 1 - view.argmin(axis=1)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.concatenate([first[1:], [len(chosen)]]) - 1
    at = chosen[first]
    return seeds[at], at, first, last


def text_words(text: str | None):
    data = as_bytes(text)
    starts, ends = spans(data, WHITE)
    return data, starts, ends, word_hashes(data, starts, ends)


def stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...`` of every stretch, one stretch behind the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - before, sizes)


def _list(values: list[np.ndarray], kind) -> pa.Array:
    joined = np.concatenate(values) if values else np.empty(0, dtype=kind)
    return pa.array(joined.view(np.int64) if joined.dtype == np.uint64 else joined)


def _anchor_rows(docs: DataFrame, positions: bool) -> DataFrame:
    """``anchor, doc`` once per document, or ``anchor, text_id, at`` for every occurrence."""
    key = "text_id" if positions else "doc"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(key).to_numpy()
            hashes, doc, at = [], [], []
            for i, text in enumerate(batch.column("body")):
                own, where, _, _ = anchors(text_words(text.as_py())[3])
                if not positions:
                    own = np.unique(own)
                hashes.append(own)
                doc.append(np.full(len(own), ids[i], dtype=np.int64))
                at.append(where)
            out = {"anchor": _list(hashes, np.uint64), key: _list(doc, np.int64)}
            if positions:
                out["at"] = _list(at, np.int64).cast(pa.int32())
            yield pa.RecordBatch.from_pydict(out)

    return docs.select(key, "body").mapInArrow(run, f"anchor bigint, {key} bigint" + (", at int" if positions else ""))


def _extents(docs: DataFrame, seeded: DataFrame) -> DataFrame:
    """``anchor, doc, text_id, start, windows``: the run of windows around each shared anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, hashes, start, windows, sizes = [], [], [], [], []
            shared = batch.column("at")
            spots, ends = shared.flatten().to_numpy(), np.cumsum(shared.value_lengths().to_numpy())
            for i, text in enumerate(batch.column("body")):
                words = text_words(text.as_py())[3]
                own, where, first, last = anchors(words)
                mine = np.flatnonzero(np.isin(where, spots[ends[i - 1] if i else 0 : ends[i]]))
                row.append(np.full(len(mine), i, dtype=np.int64))
                hashes.append(own[mine])
                start.append(first[mine])
                sizes.append(last[mine] + 1 - first[mine])
                windows.append(run_hashes(words, WINDOW)[stretches(first[mine], sizes[-1])])
            row = _list(row, np.int64)
            sizes = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else [0]
            yield pa.RecordBatch.from_pydict({
                "anchor": _list(hashes, np.uint64),
                "doc": batch.column("doc").take(row),
                "text_id": batch.column("text_id").take(row),
                "start": _list(start, np.int64).cast(pa.int32()),
                "windows": pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), _list(windows, np.uint64)),
            })

    return docs.join(seeded, "text_id").select("doc", "text_id", "body", "at").mapInArrow(
        run, "anchor bigint, doc bigint, text_id bigint, start int, windows array<bigint>"
    )


def _hot(counted: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that hold more than one row in ``HOT`` of all: ``HOT`` of them at most, whatever the table holds."""
    total = counted.agg(F.sum("n")).first()[0] or 0
    return keep(counted.where(F.col("n") * HOT > total).select(*keys, F.lit(True).alias("hot")), "hot")


def _join_split(rows: DataFrame, facts: DataFrame, keys: list[str], hot: DataFrame, spread) -> DataFrame:
    """``rows`` joined with ``facts`` (one per key), the rows of hot keys dealt over ``PARTS`` parts by ``spread``.

    A hot key's last column is hashed together with the part, so rows are no wider than without.
    """
    last = keys[-1]

    def split(side: DataFrame, part) -> DataFrame:
        return side.withColumn(last, F.when(F.col("hot"), F.xxhash64(last, part)).otherwise(F.col(last))).drop("hot", "part")

    parts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    left = split(rows.join(F.broadcast(hot), keys, "left"), F.pmod(F.xxhash64(*spread), F.lit(PARTS)).cast("int"))
    right = split(facts.join(F.broadcast(hot), keys, "left").withColumn("part", F.explode(parts)), F.col("part"))
    return left.join(right, keys)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``doc, text_id, start, marks``: extents, and for each of their windows whether it is a repeat.

    ``docs`` has ``doc`` (not null), ``text_id`` (a hash of ``doc`` and ``body``) and ``body``. Should two
    texts share a ``text_id``, each is only asked about more anchors than needed.
    """
    spark = docs.sparkSession
    shared = keep(
        _anchor_rows(docs, False).groupBy("anchor").agg(
            F.min("doc").alias("low"), F.max("doc").alias("high"), F.count(F.lit(1)).alias("n")
        ).where("low < high").select("anchor", "n"),
        "shared",
    )
    free(spark)
    found = _join_split(_anchor_rows(docs, True), shared.select("anchor"), ["anchor"], _hot(shared, ["anchor"]), ["text_id", "at"])
    seeded = keep(found.groupBy("text_id").agg(F.collect_set("at").alias("at")), "seeded")
    free(spark)
    extents = keep(_extents(docs, seeded), "extents")
    free(spark)
    kind = F.xxhash64("windows")
    classes = keep(
        extents.groupBy("anchor", kind.alias("kind")).agg(F.min("doc").alias("low"), F.count(F.lit(1)).alias("n")), "classes"
    )
    hot = _hot(classes, ["anchor", "kind"])
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    # one occurrence of each class that has to be compared window by window
    compared = classes.join(several, "anchor").select("anchor", "kind", "low")
    models = (
        _join_split(extents.withColumn("kind", kind), compared, ["anchor", "kind"], hot, ["doc", "start"])
        .where(F.col("doc") == F.col("low"))
        .select("anchor", kind.alias("kind"), "low", "windows")
        .dropDuplicates(["anchor", "kind"])
    )
    models = keep(models, "models")
    each = models.select("anchor", "kind", "low", F.posexplode("windows").alias("i", "window"))
    lowest = each.groupBy("anchor", "window").agg(F.min("low").alias("lowest"))
    by_window = (
        each.join(lowest, ["anchor", "window"])
        .groupBy("anchor", "kind")
        .agg(F.sort_array(F.collect_list(F.struct("i", "lowest"))).alias("found"))  # at most 9 windows
        .select("anchor", "kind", F.col("found.lowest").alias("lows"))
    )
    by_window = keep(by_window, "by-window")
    free(spark)
    facts = classes.select("anchor", "kind", "low").join(by_window, ["anchor", "kind"], "left")
    places = extents.select("anchor", kind.alias("kind"), "doc", "text_id", "start", F.size("windows").alias("n"))
    judged = (
        _join_split(places, facts, ["anchor", "kind"], hot, ["doc", "start"])
        .select(
            "doc",
            "text_id",
            "start",
            F.when(F.col("lows").isNotNull(), F.transform("lows", lambda low: low < F.col("doc")))
            .otherwise(F.array_repeat(F.col("low") < F.col("doc"), F.col("n")))
            .alias("marks"),
        )
        .where(F.exists("marks", lambda m: m))
    )
    return judged


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_text, repeats``.

    ``repeats`` are the maximal repeats as pairs of first word and word behind the last.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(id_col, text_col).alias("text_id"),
        F.col(text_col).alias("body"),
    )
    marked = keep(
        repeated_windows(rows.drop("doc_id"))
        .groupBy("doc", "text_id")
        .agg(F.collect_set(F.struct("start", "marks")).alias("found")),
        "marked",
    )
    free(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept, spots = [], [], [], []
            found = batch.column("found")
            start, marks = found.flatten().flatten()
            sizes = marks.value_lengths().to_numpy()
            marked = marks.flatten().to_numpy(zero_copy_only=False).astype(bool)
            windows = stretches(start.to_numpy().astype(np.int64), sizes)[marked]
            # number of marked windows up to the end of each text's extents
            upto = np.concatenate([[0], np.cumsum(marked)])
            extents = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(found.value_lengths().fill_null(0).to_numpy())]
            ends = upto[extents]
            for i, text in enumerate(batch.column("body")):
                # bytes are split at the very characters that separate words
                own = as_bytes(text.as_py()).tobytes().split()
                total.append(len(own))
                at = windows[ends[i - 1] if i else 0 : ends[i]]
                if not len(at):
                    gone.append(0)
                    kept.append(b" ".join(own))
                    spots.append([])
                    continue
                turn = np.bincount(at, minlength=len(own) + 1) - np.bincount(at + WINDOW, minlength=len(own) + 1)
                cover = np.cumsum(turn)[:-1] > 0
                gone.append(int(cover.sum()))
                kept.append(b" ".join(compress(own, (~cover).tolist())))
                edge = np.flatnonzero(np.diff(np.concatenate([[False], cover, [False]])))
                spots.append([[int(a), int(b)] for a, b in zip(edge[::2], edge[1::2])])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(total, pa.int64()),
                "n_removed": pa.array(gone, pa.int64()),
                "kept_text": pa.array(kept, pa.binary()),
                "repeats": pa.array(spots, pa.list_(pa.list_(pa.int64()))),
            })

    return (
        rows.join(marked, ["doc", "text_id"], "left")
        .select("doc_id", "body", "found")
        .mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_text binary, repeats array<array<bigint>>")
        .withColumn("kept_text", F.decode("kept_text", "UTF-8"))
    )
