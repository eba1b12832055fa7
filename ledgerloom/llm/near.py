"""Near duplicates by order MinHash and banded alignment.

Texts are lower-cased; words are what stands between ASCII characters other than letters and
digits; shingles are runs of five words, in text order (a text of one to four words is one
shingle). The similarity of two texts is ``L / (n + m - L)`` for ``n`` and ``m`` shingles of which
at most ``L`` can be aligned in order: the Jaccard index, made sensitive to order. Pairs of
``SIMILAR`` or more are linked.

Sketch: shingles are labelled with their occurrence number. For each of ``ENTRIES`` hash
functions the ``PICKED`` smallest labelled shingles are taken and hashed in the order of the text.
Texts that agree in an entry are candidates. At a similarity of 0.8 a pair is missed with a
probability below 1 in 1,000; texts of up to ``SHORT`` shingles also get entries of two.

Large buckets: texts of equal words are one node (similarity 1) before anything else. Every node
is first compared with one other, the smallest node of any of its buckets. Then, while they are still in
different components of the links found, with the smallest and the largest of each bucket. What is apart after that is compared
pair by pair, except where an exact bound rules a link out: the triangle inequality of the multiset
Jaccard distance, the ratio of lengths, or counts of shingles by hash class. A large group of near
copies has become one component by then, but for a few texts; no link that joins two
components is lost.

Classes are connected components of the links; ``class_id`` is the smallest id in it.

Defined results: null, empty and punctuation-only texts have no words and form one class.
Repeated rows belong to one class and get a row each. Null ids are allowed, and count as larger
than any other. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.graph import components
from ledgerloom.llm.store import free, keep
from ledgerloom.llm.words import NON_WORD, as_bytes, mix, shingles, spans, word_hashes

WORDS = 5
SIMILAR = 0.8
ENTRIES = 32
PICKED = 6
SHORT = 24
CLASSES = 64
#: classes for the last bound, where many texts of a bucket stand just apart
FINE = 256

_rng = np.random.default_rng(20_240_601)
_FACTORS = _rng.integers(0, 1 << 63, size=ENTRIES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _rng.integers(0, 1 << 63, size=PICKED, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def plain(text: Column) -> Column:
    """Lower-cased words joined by single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def text_shingles(text: str) -> np.ndarray:
    data = as_bytes(text)
    return shingles(word_hashes(data, *spans(data, NON_WORD)), WORDS)


def labelled(hashes: np.ndarray) -> np.ndarray:
    """Each shingle made distinct by how often it occurred before."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    at = np.arange(len(hashes))
    nth = np.empty(len(hashes), dtype=np.uint64)
    nth[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return mix(hashes + nth * np.uint64(0xA24BAED4963EE407))


def sketch(labels: np.ndarray) -> np.ndarray:
    """The entries of one text."""
    entries = [_entries(labels, PICKED, 0)]
    if len(labels) <= SHORT:
        entries.append(_entries(labels, 2, 1 << 20))
    return np.unique(np.concatenate(entries))


def _entries(labels: np.ndarray, picked: int, salt: int) -> np.ndarray:
    if not len(labels):
        return np.empty(0, dtype=np.uint64)
    out = np.empty(ENTRIES, dtype=np.uint64)
    group = max(1, min(ENTRIES, (1 << 20) // len(labels)))  # bounds the memory for a very long text
    for first in range(0, ENTRIES, group):
        hashed = labels[None, :] * _FACTORS[first : first + group, None]
        hashed ^= hashed >> np.uint64(32)
        if picked < len(labels):
            chosen = np.sort(np.argpartition(hashed, picked - 1, axis=1)[:, :picked], axis=1)
        else:
            chosen = np.broadcast_to(np.arange(len(labels)), (len(hashed), len(labels)))
        in_order = labels[chosen] * _PLACES[: chosen.shape[1]]
        out[first : first + group] = mix(
            in_order.sum(axis=1, dtype=np.uint64) + np.arange(first, first + len(hashed), dtype=np.uint64) + np.uint64(salt)
        )
    return out


def aligned(x: np.ndarray, y: np.ndarray, band: int) -> int:
    """Most elements that can be matched in order, none further than ``band`` from the diagonal.

    Bit-parallel: a set bit says that the row below does not gain a match. Only the bits of the
    band are held; the window moves by one with each element of ``y``.
    """
    places: dict[int, list[int]] = {}
    for i, v in enumerate(x.tolist()):
        places.setdefault(v, []).append(i)
    width = 2 * band + 1
    full = (1 << width) - 1
    window = full  # bit b stands for element j - band + b of x
    gained = 0
    for j, v in enumerate(y.tolist()):
        low = j - band
        found = 0
        for i in places.get(v, ()):
            if 0 <= i - low < width:
                found |= 1 << (i - low)
        if found:
            hit = window & found
            window = ((window + hit) | (window & ~found)) & full
        gained += not window & 1  # this bit leaves the band
        window = (window >> 1) | (1 << (width - 1))
    return gained + width - window.bit_count()


def compare(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Multiset Jaccard distance, and the similarity if it is ``SIMILAR`` or more, else 0."""
    n, m = len(x), len(y)
    if not n or not m:
        return (0.0, 1.0) if n == m else (1.0, 0.0)
    common = len(np.intersect1d(labelled(x), labelled(y), assume_unique=True))
    distance = 1 - common / (n + m - common)
    if common < SIMILAR * (n + m - common):
        return distance, 0.0
    least = int(np.ceil(SIMILAR * (n + m) / (1 + SIMILAR) - 1e-9))
    band = n + m - 2 * least
    short = min(n, m)
    differ = np.flatnonzero(x[:short] != y[:short])
    head = int(differ[0]) if len(differ) else short
    rest = short - head
    differ = np.flatnonzero(x[n - rest :][::-1] != y[m - rest :][::-1]) if rest else differ
    tail = int(differ[0]) if rest and len(differ) else rest
    found = head + tail + aligned(x[head : n - tail], y[head : m - tail], band)
    similarity = found / (n + m - found)
    return distance, similarity if similarity >= SIMILAR - 1e-12 else 0.0


def _sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, counts, fine, entries = [], [], [], []
            for text in batch.column("words"):
                x = text_shingles(text.as_py())
                sizes.append(len(x))
                fine.append(np.bincount((x >> np.uint64(56)).astype(np.int64), minlength=FINE))
                counts.append(fine[-1].reshape(CLASSES, -1).sum(axis=1))
                entries.append(sketch(labelled(x)).view(np.int64))
            yield pa.RecordBatch.from_pydict({
                **{name: batch.column(name) for name in ("row", "id", "digest")},
                "n": pa.array(sizes, pa.int32()),
                "counts": pa.array(counts, pa.list_(pa.int32())),
                "fine": pa.array(fine, pa.list_(pa.int32())),
                "entries": pa.array(entries, pa.list_(pa.int64())),
            })

    words = plain(F.col(text_col))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.unhex(F.md5(words)).alias("digest"),
        words.alias("words"),
    ).mapInArrow(run, "row bigint, id bigint, digest binary, n int, counts array<int>, fine array<int>, entries array<bigint>")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Add ``distance`` and ``similarity`` to rows ``x, y``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[int, np.ndarray] = {}
        for batch in batches:
            found = []
            for x, y, a, b in zip(batch["x"], batch["y"], batch["x_words"], batch["y_words"]):
                if y not in last:  # many rows in a row have the same y
                    last = {y: text_shingles(b)}
                found.append(compare(text_shingles(a), last[y]))
            out = batch[["x", "y"]].copy()
            out["distance"], out["similarity"] = [f[0] for f in found], [f[1] for f in found]
            yield out

    return (
        pairs.join(texts.select(F.col("node").alias("x"), F.col("words").alias("x_words")), "x")
        .join(texts.select(F.col("node").alias("y"), F.col("words").alias("y_words")), "y")
        .select("x", "y", "x_words", "y_words")
        .mapInPandas(run, "x bigint, y bigint, distance double, similarity double")
    )


def _texts(docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """``node, words`` of the asked nodes, each from one of the rows with its words."""
    wanted = nodes.join(asked, "node", "left_semi")
    words = plain(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("own_id"), F.unhex(F.md5(words)).alias("own_digest"), words.alias("words"))
    # the digest is a key of the join: rows without an id, or with one id, do not all meet
    found = rows.join(wanted, (F.col("own_digest") == F.col("digest")) & F.col("own_id").eqNullSafe(F.col("id")))
    # several rows can have the same id and the same words: any of them will do
    return keep(found.dropDuplicates(["node"]).select("node", "words"), "texts")


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows with their node (``id, digest, node``), and links between nodes (``x, y, similarity``)."""
    sketches = keep(_sketches(docs, id_col, text_col), "sketches")
    same = keep(sketches.groupBy("digest").agg(F.min("row").alias("node")), "nodes")
    rows = sketches.select("id", "digest").join(same, "digest").select("id", "digest", "node")
    first = sketches.join(same.select("node"), F.col("row") == F.col("node"), "left_semi").drop("id", "digest")
    nodes = sketches.select("row", "id", "digest").join(same.select("node"), F.col("row") == F.col("node")).drop("row")
    entries = first.select(F.col("row").alias("node"), F.explode("entries").alias("entry"))
    shared = (
        entries.groupBy("entry").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    )
    facts = first.select(F.col("row").alias("node"), "n", "counts")
    buckets = keep(entries.join(shared, "entry").join(facts, "node"), "buckets")
    # a node's words are needed if it shares a bucket
    texts = _texts(docs, id_col, text_col, nodes, buckets.select("node").distinct())
    free(docs.sparkSession)

    # one comparison per node: in a group of near copies nearly all are linked by it
    nearest = buckets.groupBy(F.col("node").alias("x")).agg(F.min("low").alias("y")).where("x != y")
    compared = keep(_verified(_likely(nearest, facts), texts), "compared")
    found = compared.where("similarity > 0").select("x", "y", "similarity")
    # then around the first and the last node of each bucket, for what is still apart
    pairs = _star(_named(buckets, found), "low").join(compared.select("x", "y"), ["x", "y"], "left_anti")
    compared = keep(compared.unionByName(_verified(pairs, texts)), "compared")
    found = compared.where("similarity > 0").select("x", "y", "similarity")
    named = _named(buckets, found)
    found = keep(found.unionByName(_verified(_star(named, "high"), texts).where("similarity > 0").drop("distance")), "found")
    # the rest of each bucket, between parts that are still apart
    left = _left(_named(buckets, found), compared, first.select(F.col("row").alias("node"), "entries", "fine"))
    more = _verified(left, texts).where("similarity > 0").drop("distance")
    return rows, keep(found.unionByName(more), "links")


def _possible() -> Column:
    """Whether rows ``u`` and ``v`` can be linked, by their numbers of shingles and counts by hash class."""
    return (F.least("u.n", "v.n") >= SIMILAR * F.greatest("u.n", "v.n")) & _counts_agree("counts")


def _counts_agree(counts: str) -> Column:
    gap = F.aggregate(
        F.zip_with(F.col(f"u.{counts}"), F.col(f"v.{counts}"), lambda a, b: F.abs(a - b)), F.lit(0), lambda a, b: a + b
    )
    # every shingle too many or too few in a class costs an insertion or deletion; (n + m) / 9 are allowed
    return gap <= (F.col("u.n") + F.col("v.n")) * (1 - SIMILAR) / (1 + SIMILAR) + 1e-9


def _likely(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """The pairs ``x, y`` that can be linked."""
    u, v = facts.alias("u"), facts.alias("v")
    both = pairs.join(u, F.col("x") == F.col("u.node")).join(v, F.col("y") == F.col("v.node"))
    return both.where(_possible()).select("x", "y")


def _star(buckets: DataFrame, middle: str) -> DataFrame:
    """Pairs of nodes in different components, each with the node in its bucket's ``middle`` column, if a link is possible."""
    u, v = buckets.alias("u"), buckets.where(F.col("node") == F.col(middle)).alias("v")
    pairs = u.join(v, F.col("u.entry") == F.col("v.entry")).where((F.col("u.component") != F.col("v.component")) & _possible())
    return pairs.select(F.col("u.node").alias("x"), F.col("v.node").alias("y")).distinct()


def _named(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """Bucket rows with the component that their node belongs to so far."""
    return keep(
        buckets.join(components(found), "node", "left").withColumn("component", F.coalesce("component", "node")), "named"
    )


def _left(named: DataFrame, compared: DataFrame, entries: DataFrame) -> DataFrame:
    """Pairs of nodes in a bucket and in different components that no bound rules out as links."""
    from_low = compared.select(F.col("x").alias("node"), F.col("y").alias("low"), "distance")
    # only buckets with several components matter; the first node is as far from itself as nothing
    several = (
        named.groupBy("entry").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("entry")
    )
    apart = F.when(F.col("node") == F.col("low"), 0.0).otherwise(F.col("distance"))
    rows = keep(
        named.join(several, "entry").join(from_low, ["node", "low"], "left").join(entries, "node")
        .select("entry", "node", "component", apart.alias("distance"), "n", "counts", "fine", "entries"),
        "apart",
    )
    u, v = rows.alias("u"), rows.alias("v")
    far = F.abs(F.col("u.distance") - F.col("v.distance")) > 1 - SIMILAR + 1e-9  # null where one is not known
    return (
        u.join(v, F.col("u.entry") == F.col("v.entry"))
        .where((F.col("u.node") < F.col("v.node")) & (F.col("u.component") != F.col("v.component")))
        .where(~F.coalesce(far, F.lit(False)) & _possible() & _counts_agree("fine"))
        # a pair is looked at in the smallest of the entries that it shares
        .where(F.array_min(F.array_intersect("u.entries", "v.entries")) == F.col("u.entry"))
        .select(F.col("u.node").alias("x"), F.col("v.node").alias("y"))
    )


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, kept, class_md5``, and ``words_md5`` of its plain words.

    Kept are the rows with the smallest id of the class and, should that id occur with several
    texts, the smallest ``words_md5`` among them, which is the class's ``class_md5``: it tells classes apart
    that have an id in common.
    """
    rows, edges = links(docs, id_col, text_col)
    rows = keep(
        rows.join(components(edges), "node", "left").select(
            "id", "digest", F.coalesce("component", "node").alias("component")
        ),
        "members",
    )
    place = F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"), F.col("digest").alias("digest"))
    sizes = rows.groupBy("component").agg(F.min(place).alias("stays"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(sizes, "component").select(
        F.col("id").alias("doc_id"),
        F.col("stays.id").alias("class_id"),
        "class_size",
        (F.col("id").eqNullSafe(F.col("stays.id")) & (F.col("digest") == F.col("stays.digest"))).alias("kept"),
        F.lower(F.hex("stays.digest")).alias("class_md5"),
        F.col("digest").alias("words_md5"),
    )
