"""The prefix trie against dictionaries of prefixes in plain Python."""

import collections
import hashlib
import random
import zlib

import pytest
from conftest import SF
from pyspark.sql import functions as F

from ledgerloom.llm import trie
from ledgerloom.llm.queries import QUERIES


def turn_order(row):
    _, turn, role, text = row
    own = f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()
    return (turn is not None, turn or 0, hashlib.sha256(own).digest())


def expected(rows):
    own = collections.defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=turn_order):
        own[row[0]].append((row[2] or "", row[3] or ""))
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        whole[c] = tuple(base[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, own_members in members.items():
        gain = (len(own_members) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += gain
    out = []
    for path, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(path))
        out.append((
            min(m), len(path), min(members[path[:-1]]) if path else None, len(m), children[path], leaves[path], saved[path],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def table(spark, rows):
    out = spark.createDataFrame(rows, SCHEMA)
    return out.withColumns({c: F.lit("clash") for c in ("key", "path", "at", "place", "size", "block", "h", "n", "depth", "own")})


def random_rows(seed, convs=160, few=3):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-250, 700), convs):
        texts = [r.choice("abcdé日"[:few]) for _ in range(r.randint(1, 9))]
        rows += [(c, i, r.choice(["user", "assistant"][: 1 + (seed % 2)]), t * r.randint(1, 2)) for i, t in enumerate(texts)]
    return rows


def messy_rows():
    rows = random_rows(5)
    rows += [(c, i, "user", "same") for c in range(1000, 1060) for i in range(4)]  # copies
    rows += [(2000, None, None, None), (2000, None, "user", ""), (2000, 1, None, "x"), (2000, 1, None, "x"), (2000, 7, "user", "y")]
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None), (5555, 0, "ab", "c"), (5556, 0, "a", "bc")]
    rows += [(3100, 9, "user", "late"), (3100, -9, "user", "early"), (3107, 0, "user", "one only")]
    return rows


def same(got, rows):
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)


def test_trie_of_messy_rows(spark):
    got = trie.prefix_trie(table(spark, messy_rows()))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    same(got, messy_rows())
    assert trie.prefix_trie(table(spark, [])).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_small_blocks_and_chunks(spark, seed):
    """Nodes shared by chunks, blocks that hang on others, conversations that end where a block does."""
    rows = random_rows(seed, 120) + [(c, i, "user", "same") for c in range(1000, 1040) for i in range(6)]
    rows += [(c, i, "user", f"long {i}") for c in (2000, 2001) for i in range(11)] + [(2101, i, "user", f"alone {i}") for i in range(13)]
    same(trie.prefix_trie(table(spark, rows), block=2, size=12, piece=3), rows)


def test_only_conversations_without_turns(spark):
    rows = [(c, 0, "user", "gone") for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6]
    same(trie.prefix_trie(table(spark, rows)), rows)


def test_double_array():
    r = random.Random(8)
    paths = sorted({tuple(bytes([r.randint(0, 40)]) * 2 for _ in range(r.randint(0, 5))) for _ in range(3000)})
    array, ids, order = trie.build([list(p) for p in paths])
    seen = {(): 1}
    for path in paths:
        node = 1
        for i, turn in enumerate(path):
            node = array.child(node, ids[turn])
            assert node > 1 and seen.setdefault(path[: i + 1], node) == node
    assert sorted(seen.values()) == sorted(order)  # as many slots as prefixes, each once
    assert sum(c > 0 for c in array.check) == len(order) - 1
    assert len(array.check) <= trie.LOOSE * len(order) + len(ids)
    assert not array.child(1, len(ids) + 1)


def test_wide_children_do_not_blow_up_the_array():
    first = [[b"%06d" % i] for i in range(4000)]
    pairs = [[b"z%d" % i, b"%06d" % j] for i in range(1500) for j in (i, 3999 - i)]
    array, _, order = trie.build(sorted(first + pairs))
    assert len(array.check) < 8 * len(order)


def test_trie_of_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(QUERIES["op13_prefix_trie"](spark, SF), rows)
