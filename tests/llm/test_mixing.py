"""Entropy balancing against a solver in plain Python, and copies against their bounds."""

import collections
import math
import random
import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from ledgerloom.llm import mixing, order
from ledgerloom.llm.queries import QUERIES


def n_words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def plain_targets(totals, weights=(5, 2, 1)):
    names = sorted(totals, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    whole, capped = sum(totals.values()), {}
    while True:
        left = whole - sum(capped.values())
        open_ = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * totals[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * totals[s] for s in over}


def plain_tilt(sizes, target):
    def taken(tilt):
        return sum(x * math.exp(min(math.log(3), tilt * x)) for x in sizes)

    low, high = -50.0, 50.0
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if taken(mid) < target else (low, mid)
    return low


def corpus(seed=4):
    r = random.Random(seed)
    rows = []
    for source, n in (("b", 400), ("a", 60), ("é", 30), ("Z", 5), ("\U0001f600", 40), ("￮", 20), (None, 80), ("blank", 3)):
        for _ in range(n):
            size = 0 if source == "blank" else r.choice([0, 1, 7, 7, 7, 20, 33, r.randint(1, 400)])
            rows.append((len(rows), source, " ".join(["w"] * size)))
    rows += [(9000, "b", "same text here")] * 500 + [(None, "a", None), (None, "a", "null id"), (None, None, "x\ty\x0bz  q\n")]
    rows += [(9001, "a", "long " * 500)]
    rows += [(9002, "outweighed", "long " * 20_000), (9003, "outweighed", "short text")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    out = spark.createDataFrame(corpus(), "doc_id bigint, source string, text string")
    return out.withColumns({c: F.lit("clash") for c in ("size", "bare", "hash", "slice", "n", "copies", "target", "tilt", "turn", "weight")})


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select(F.col("id").alias("v"), F.pmod(F.xxhash64("id"), F.lit(97)).alias("k"))
    got = order.numbered(df, [F.col("k").desc(), F.col("v")], "at").orderBy("at").collect()
    assert [r["at"] for r in got] == list(range(1000))
    assert [(r["k"], r["v"]) for r in got] == sorted(((r["k"], r["v"]) for r in got), key=lambda x: (-x[0], x[1]))
    assert order.numbered(df.limit(0), [F.col("v")], "at").collect() == []


def check(rows, got):
    """Every contract of the mix."""
    totals = collections.Counter()
    for _, source, text in rows:
        totals[source] += n_words(text)
    targets = plain_targets(totals)
    want = sorted(((d, s, n_words(t)) for d, s, t in rows), key=str)
    assert sorted(((r["doc_id"], r["source"], r["size"]) for r in got), key=str) == want
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == totals[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]], rel=1e-12)
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in targets.items():
        # no single copy more or less brings the words nearer
        able = [r["size"] for r in got if r["source"] == s and r["size"] and (r["copies"] < 3 if taken[s] < t else r["copies"])]
        assert abs(taken[s] - t) <= max(1, min(able, default=0)), (s, taken[s], t)


def test_mix(spark, docs):
    got = mixing.mix(docs).collect()
    check(corpus(), got)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    assert mixing.mix(docs.limit(0)).collect() == []


def test_tilts_are_the_dual_solution(spark, docs):
    rows = mixing.sizes(docs)
    cells = rows.groupBy("bare", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    tilts = mixing.balance(cells, mixing.shared_targets(mixing.source_totals(cells)))
    by_source = collections.defaultdict(list)
    for _, source, text in corpus():
        by_source[source].append(n_words(text))
    for r in tilts.collect():
        sizes = by_source[None if r["bare"] else r["source"]]
        if sum(sizes) and r["target"] < 3 * sum(sizes):
            assert r["tilt"] == pytest.approx(plain_tilt(sizes, r["target"]), rel=1e-5, abs=1e-12)


def test_copies_follow_the_rates(spark, docs):
    """For every source the copies up to a size are those that the rates say, but for single ones."""
    rows = mixing.sizes(docs)
    cells = rows.groupBy("bare", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    tilts = mixing.balance(cells, mixing.shared_targets(mixing.source_totals(cells))).collect()
    tilt = {(r["bare"], r["source"]): r["tilt"] for r in tilts}
    copies = collections.defaultdict(lambda: [0, 0])
    for r in mixing.mix(docs).collect():
        copies[r["source"] is None, r["source"] or "", r["size"]][0] += 1
        copies[r["source"] is None, r["source"] or "", r["size"]][1] += r["copies"]
    so_far = collections.Counter()
    for (bare, source, size), (n, made) in sorted(copies.items()):
        so_far[bare, source] += n * min(3, math.exp(min(2, tilt[bare, source] * size))) - made
        assert abs(so_far[bare, source]) < 12, (source, size)


def test_mix_of_given_documents(spark):
    got = QUERIES["op11_mixing"](spark, SF)
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text").collect()
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    check([tuple(r) for r in rows], mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")).collect())


def test_mix_runs_no_python(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow|ArrowEval", plan)
