"""Periodic runs against a search over all stretches, and the query's digests against plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

from conftest import SF
from pyspark.sql import functions as F

from ledgerloom.llm import periods
from ledgerloom.llm.queries import QUERIES


def all_runs(words):
    """Every maximal stretch of every period, kept if no smaller period fits it."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, size = i - q, j - i + q
            part = words[start : start + size]
            smaller = any(part[d:] == part[:-d] for d in range(1, q))
            if size >= max(24, 3 * q) and not smaller:
                found.append((start, size, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    if doc is not None and n:
        h = zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = all_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    drop = {i for s, size, q in found for i in range(s + q, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    return (
        doc, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def pattern(r, size, letters):
    return [r.choice(letters) for _ in range(size)]


def mixed_texts(n, seed):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        words = []
        for _ in range(r.randint(1, 6)):
            unit = pattern(r, r.randint(1, 40), r.choice(["ab", "abc", "abcdefghijklmnop"]))
            words += (unit * r.randint(1, 8))[: r.randint(1, 200)] if r.random() < 0.7 else pattern(r, r.randint(0, 60), "abxyz")
        out.append([w.encode() for w in words])
    return out


def test_runs_of_random_mixes():
    for words in mixed_texts(150, 7):
        assert periods.runs(words) == all_runs(words), words


def test_nested_and_long_periods():
    r = random.Random(3)
    unit = [b"a"] * 30 + [b"b"] + [b"x", b"y"] * 15
    long = [str(r.random()).encode() for _ in range(333)]
    for words in (unit * 4, unit * 3 + unit[:-1], long * 3, long * 3 + long[:5], [b"z"] + long * 3 + long[:1], long * 2 + long[:-1]):
        assert periods.runs(words) == all_runs(words)


def test_one_word_many_times_is_linear():
    n = 1_000_000
    assert periods.runs([b"no"] * n) == [(0, n, 1)]


def test_equal_hashes_of_different_words(monkeypatch):
    class Same(bytes):
        def __hash__(self):
            return 1

    words = [Same(w) for w in [b"a", b"b"] * 20]
    assert periods.runs(words) == [(0, 40, 2)]
    words = [Same(str(i).encode()) for i in range(60)]
    assert periods.runs(words) == []


def messy_rows():
    texts = [None, "", " \n\t ", "a " * 23, "a " * 24, "a b " * 30, "é ñ 日本 " * 12, "w " * 5000 + "x " * 40, "same", "same"]
    rows = [(i, " ".join(w.decode() for w in words)) for i, words in enumerate(mixed_texts(60, 11))]
    return rows + [(100 + i, t) for i, t in enumerate(texts)] + [(None, "b " * 30), (None, None), (7, "b " * 30), (7, "b " * 30), (-5, "q r " * 50)]


def test_periods_of_messy_rows(spark, tmp_path):
    rows = messy_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("clash") for c in ("id", "body", "runs", "best", "start")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op12_periods"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((expected(*r) for r in rows), key=str)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert periods.periodic_runs(empty).collect() == []


def test_periods_of_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op12_periods"](spark, SF).collect()}
    assert len(got) == len(docs)
    short = [r for r in docs if len((r["text"] or "")) < 8000]  # the search over all stretches is quadratic
    assert len(short) > len(docs) / 2
    assert all(got[r["doc_id"]] == expected(*r) for r in short)
    assert sum(r[1] > 0 for r in got.values()) > len(docs) / 20
