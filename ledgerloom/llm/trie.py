"""The prefix trie of conversations, by double-array tries per shard.

A turn is known by a 128-bit digest of its role and text, a conversation by the row of its turns' digests. Rows
are cut into blocks of ``BLOCK`` turns, so that no row of a table grows with a conversation. The block of a prefix is
a trie of its own below the prefix's node; equal blocks of a prefix are one row with a count before any trie is built.

Shards: those rows are dealt by ranges of prefix and path, hence any number of conversations may share their first turns,
or be equal. A task packs ``CHUNK`` turns at a time: turns get dense ids in the order of levels, so that siblings
have neighbouring ids; ``BASE`` and ``CHECK`` place the children of a node at ``BASE[node] + id``, first fit, nodes with
one child in the holes. Traversing the rows adds up members; ``CHECK`` is also the way from a child to its parent, on which
leaves and savings go up.

Shared upper nodes: only nodes on the paths of a chunk's first and last row can also lie in another chunk. They are few, are
merged by key over all chunks, and pass what they hold themselves on to their ancestors. Blocks are done from the deepest
shared one upwards, each giving the totals of its root to the node it hangs on; a prefix with one member needs no such round, its
further blocks are chains that are done in one go. So rounds grow with the depth that conversations share, by ``BLOCK``.

The digest of the members that end at a node takes their ids in order. They are sorted by ranges of node and id, joined
to pieces of ``PIECE`` ids, and a node's pieces pass one task as a stream (SHA-256 has no other way).

Defined results: null roles and texts count as empty. Turns go by ``turn``, null first; equal turn numbers by the digest of role
and text, so a repeated row is a turn of its own. Rows without ``conv_id`` belong to no conversation and make no nodes. No
conversations, no nodes. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.order import numbered
from ledgerloom.llm.store import keep

#: turns in a row of the tables
BLOCK = 256
#: turns in a double array, about
CHUNK = 100_000
#: ids in a piece of a node's members
PIECE = 4096
#: turns that a conversation takes over from the first of its hundred, at most
TAKEN = 5
WIDTH = 16
ROOT = bytes(WIDTH)
#: slots per node up to which a double array grows rather than searches on
LOOSE = 4

ROWS = ["block", "prefix", "path", "sizes", "conv", "n", "n_last", "alone", "add_children", "add_leaves", "add_saved"]
OUT = (
    "key binary, parent binary, block int, depth bigint, conv bigint, n bigint, size bigint, ends boolean, children bigint,"
    " leaves bigint, saved bigint, shared boolean, up array<binary>, parent_conv bigint"
)


# --- the double array -------------------------------------------------------


class DoubleArray:
    """``BASE`` and ``CHECK`` over slots; slot 1 is the top. ``CHECK`` of a free slot is 0."""

    def __init__(self):
        self.base = [0, 0]
        self.check = [-1, -1]
        self.free = 2
        self.nodes = 1

    def _grow(self, size: int) -> None:
        more = size - len(self.check)
        if more > 0:
            self.base.extend([0] * more)
            self.check.extend([0] * more)

    def place(self, node: int, symbols: list[int]) -> list[int]:
        """Slots for the children of ``node``, by ascending ids."""
        check, first = self.check, symbols[0]
        while self.free < len(check) and check[self.free]:
            self.free += 1
        at, tries = self.free, 0
        if len(symbols) > 1:
            while at < len(check):
                if not check[at]:
                    shift = at - first
                    if all(shift + c >= len(check) or not check[shift + c] for c in symbols):
                        break
                    tries += 1
                    if tries >= 64 and len(check) <= LOOSE * (self.nodes + len(symbols)):
                        at = len(check)
                        break
                at += 1
        shift = at - first
        self._grow(shift + symbols[-1] + 1)
        self.base[node] = shift
        slots = [shift + c for c in symbols]
        for slot in slots:
            check[slot] = node
        self.nodes += len(slots)
        return slots

    def child(self, node: int, symbol: int) -> int:
        """The child's slot, 0 if there is none."""
        slot = self.base[node] + symbol
        return slot if 0 < slot < len(self.check) and self.check[slot] == node else 0


def build(paths: list[list[bytes]]) -> tuple[DoubleArray, dict[bytes, int], list[int]]:
    """The double array of sorted sequences, the dense ids, and the slots by levels."""
    trie, ids, order = DoubleArray(), {}, []
    queue = deque([(1, 0, len(paths), 0)])
    while queue:
        node, low, high, depth = queue.popleft()
        order.append(node)
        while low < high and len(paths[low]) == depth:
            low += 1
        groups = []
        while low < high:
            turn, start = paths[low][depth], low
            while low < high and paths[low][depth] == turn:
                low += 1
            groups.append((ids.setdefault(turn, len(ids) + 1), start, low))
        if groups:
            groups.sort()
            for slot, (_, start, end) in zip(trie.place(node, [g[0] for g in groups]), groups):
                queue.append((slot, start, end, depth + 1))
    return trie, ids, order


def end_key(prefix: bytes, path: list[bytes], block: int = BLOCK) -> bytes:
    """The key of the node that ``path`` leads to from ``prefix``."""
    if not path:
        return prefix
    whole = b"".join(path)
    if len(path) < block:
        return hashlib.sha256(prefix + b"#" + whole).digest()[:WIDTH]
    return hashlib.sha256(prefix + hashlib.sha256(whole).digest()).digest()[:WIDTH]


def _end_key(block: int, full: bool = False) -> Column:
    """``end_key`` of the columns ``prefix, path, digest``; ``full`` where the path is as long as a block."""
    last = F.expr(f"substring(unhex(sha2(concat(prefix, digest), 256)), 1, {WIDTH})")
    if full:
        return last
    inner = F.expr(f"substring(unhex(sha2(concat(prefix, X'23', path), 256)), 1, {WIDTH})")
    length = F.octet_length("path")
    return F.when(length == 0, F.col("prefix")).when(length == block * WIDTH, last).otherwise(inner)


def nodes_of(rows: list[dict], block_size: int = BLOCK) -> dict[str, list]:
    """All nodes of a chunk of rows, which are sorted by prefix and path, as columns of ``OUT``."""
    paths = [[r["path"][i : i + WIDTH] for i in range(0, len(r["path"]), WIDTH)] for r in rows]
    # a prefix is the first turn below the top; no turn's digest is looked up at that level
    trie, ids, order = build([[r["prefix"], *path] for r, path in zip(rows, paths)])
    made = len(trie.check)
    n, conv, size, depth = [0] * made, [None] * made, [0] * made, [0] * made
    key: list = [None] * made
    hashes: list = [None] * made
    children, leaves, saved = [0] * made, [0] * made, [0] * made
    block, alone = [0] * made, [False] * made
    ends, shared = [False] * made, [False] * made
    for i, (row, path) in enumerate(zip(rows, paths)):
        slot = trie.child(1, ids[row["prefix"]])
        walked = [slot]
        for turn in path:
            slot = trie.child(slot, ids[turn])
            walked.append(slot)
        for d, slot in enumerate(walked):
            if key[slot] is None:
                depth[slot], block[slot], alone[slot] = d, row["block"], row["alone"]
                if d == 0:
                    key[slot], hashes[slot] = row["prefix"], hashlib.sha256(row["prefix"] + b"#")
                else:
                    size[slot] = row["sizes"][d - 1]
                    own = hashes[trie.check[slot]].copy()
                    own.update(path[d - 1])
                    hashes[slot] = own
                    key[slot] = own.digest()[:WIDTH] if d < block_size else end_key(row["prefix"], path, block_size)
            n[slot] += row["n"]
            if conv[slot] is None or row["conv"] < conv[slot]:
                conv[slot] = row["conv"]
        children[slot] += row["add_children"]
        leaves[slot] += row["add_leaves"]
        saved[slot] += row["add_saved"]
        ends[slot] = ends[slot] or row["n_last"] > 0
        if i in (0, len(rows) - 1) and not row["alone"]:
            for slot in walked:
                shared[slot] = True
    for slot in order[1:]:
        shared[slot] = shared[slot] or (depth[slot] == 0 and not alone[slot])
    for slot in reversed(order[1:]):
        if shared[slot]:
            continue
        if not children[slot]:
            leaves[slot] = 1
        saved[slot] += (n[slot] - 1) * size[slot]
        above = trie.check[slot]
        children[above] += 1
        leaves[above] += leaves[slot]
        saved[above] += saved[slot]
    out: dict[str, list] = {name.split()[0]: [] for name in OUT.split(", ")}
    for slot in order[1:]:
        if alone[slot] and depth[slot] == 0:
            continue  # a node of the block above
        above = trie.check[slot] if depth[slot] else 0
        up = []
        if shared[slot]:
            step = above
            while step:
                up.append(key[step])
                step = trie.check[step] if depth[step] else 0
        known = above and not shared[above] and depth[above]
        for name, value in (
            ("key", key[slot]), ("parent", key[above] if above else None), ("block", block[slot]),
            ("depth", block[slot] * block_size + depth[slot]), ("conv", conv[slot]), ("n", n[slot]), ("size", size[slot]),
            ("ends", ends[slot]), ("children", children[slot]), ("leaves", leaves[slot]), ("saved", saved[slot]),
            ("shared", shared[slot]), ("up", up), ("parent_conv", conv[above] if known else None),
        ):
            out[name].append(value)
    return out


def _chunks(rows: Iterator[dict], size: int) -> Iterator[list[dict]]:
    held, turns = [], 0
    for row in rows:
        held.append(row)
        turns += 1 + len(row["path"]) // WIDTH
        if turns >= size:
            yield held
            held, turns = [], 0
    if held:
        yield held


def _tries(rows: DataFrame, block: int, size: int) -> DataFrame:
    """The nodes of every chunk (``OUT``) from rows with the columns ``ROWS``."""
    kinds = {"binary": pa.binary(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<binary>": pa.list_(pa.binary())}
    fields = [part.split() for part in OUT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks((row for batch in batches for row in batch.to_pylist()), size):
            out = nodes_of(chunk, block)
            yield pa.RecordBatch.from_arrays([pa.array(out[name], kinds[kind]) for name, kind in fields], [name for name, _ in fields])

    dealt = rows.select(*ROWS).repartitionByRange("prefix", "path").sortWithinPartitions("prefix", "path")
    return keep(dealt.mapInArrow(run, OUT), "tries")


# --- conversations to rows --------------------------------------------------


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, turn_key, size``: the turns of each conversation, numbered from 0."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    own = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(own, 256), 1, 2 * WIDTH)).alias("turn_key"),
        F.char_length(text).cast("long").alias("size"),
    )
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_key")]
    placed = keep(numbered(rows, by, "place").drop("turn"), "turns")
    first = placed.groupBy("conv_id").agg(F.min("place").alias("first"))
    return placed.join(first, "conv_id").select("conv_id", (F.col("place") - F.col("first")).alias("at"), "turn_key", "size")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns with those of the first conversation of the hundred put in front, and ``conv_id, total``.

    A conversation takes over ``crc32(conv_id) % 6`` turns and drops as many of its own. The remainder by 100 has
    the sign of the id.
    """
    counts = keep(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")), "counts")
    heads = counts.withColumns({
        "base": F.expr("conv_id - conv_id % 100"), "h": F.crc32(F.col("conv_id").cast("string")) % (TAKEN + 1),
    })
    there = counts.select(F.col("conv_id").alias("base"), F.col("own").alias("given"))
    heads = heads.join(there, "base", "left").withColumn("given", F.least("h", F.coalesce("given", F.lit(0))))
    heads = keep(heads.withColumn("total", F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "heads")
    own = rows.join(heads.select("conv_id", "h", "given"), "conv_id").where("at >= h")
    own = own.select("conv_id", (F.col("at") - F.col("h") + F.col("given")).alias("at"), "turn_key", "size")
    opening = rows.where(F.col("at") < TAKEN).withColumnRenamed("conv_id", "base")
    taken = opening.join(heads.select("conv_id", "base", "h"), "base").where("at < h")
    return own.unionByName(taken.select("conv_id", "at", "turn_key", "size")), heads.select("conv_id", "total")


def blocks(rows: DataFrame, totals: DataFrame, size: int = BLOCK) -> DataFrame:
    """``conv_id, block, path, sizes, last, digest, prefix``: the conversations' turns by blocks."""
    place = F.struct("at", F.hex("turn_key").alias("turn_key"), "size")
    cut = rows.groupBy("conv_id", F.expr(f"cast(at div {size} as int)").alias("block")).agg(
        F.sort_array(F.collect_list(place)).alias("turns")
    )
    bare = totals.where("total = 0").select(
        "conv_id", F.lit(0).alias("block"), F.lit(b"").alias("path"), F.expr("cast(array() as array<bigint>)").alias("sizes")
    )
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["turn_key"]), ""))
    cut = cut.select("conv_id", "block", path.alias("path"), F.col("turns.size").alias("sizes")).unionByName(bare)
    last = F.expr(f"block = greatest(total - 1, 0) div {size}")
    cut = keep(
        cut.join(totals, "conv_id").select("conv_id", "block", "path", "sizes", last.alias("last"), F.unhex(F.sha2("path", 256)).alias("digest")),
        "blocks",
    )
    prefixes = keep(_prefixes(cut.where("not last").select("conv_id", "block", "digest")), "prefixes")
    first = cut.where("block = 0").withColumn("prefix", F.lit(ROOT))
    return first.unionByName(cut.where("block > 0").join(prefixes, ["conv_id", "block"]).select(*first.columns))


def _prefixes(full: DataFrame) -> DataFrame:
    """The key of the node that each block but a conversation's first hangs on. Blocks pass in order, one digest each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, key = None, ROOT
        for batch in batches:
            keys = []
            for conv, digest in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist()):
                key = hashlib.sha256((key if conv == own else ROOT) + digest).digest()[:WIDTH]
                own = conv
                keys.append(key)
            after = pa.array([b + 1 for b in batch.column("block").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_pydict({"conv_id": batch.column("conv_id"), "block": after, "prefix": pa.array(keys, pa.binary())})

    dealt = full.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return dealt.mapInArrow(run, "conv_id bigint, block int, prefix binary")


def _distinct(cut: DataFrame) -> DataFrame:
    """One row per block that differs: members ``n``, those ending in it ``n_last``, the smallest ``conv``; ``alone`` if its prefix has one member."""
    counts = keep(
        cut.groupBy("block", "prefix", "digest").agg(
            F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("n"), F.count_if("last").alias("n_last")
        ), "counts",
    )
    sole = counts.where("block > 0").groupBy("prefix").agg((F.sum("n") == 1).alias("alone"))
    first, later = counts.where("block = 0").withColumn("alone", F.lit(False)), counts.where("block > 0").join(sole, "prefix")
    texts = cut.select(F.col("conv_id").alias("conv"), "block", "path", "sizes")
    return keep(first.unionByName(later.select(*first.columns)).join(texts, ["conv", "block"]), "distinct")


# --- nodes over all shards --------------------------------------------------


def _merged(found: DataFrame) -> DataFrame:
    """Nodes that several chunks may hold, once each, with the totals of their subtrees."""
    parts = found.where("shared").drop("shared", "parent_conv")
    once = parts.groupBy("key").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("parent", "block", "depth", "size", "up")], F.min("conv").alias("conv"),
        F.max("ends").alias("ends"), *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")],
    )
    once = keep(once, "once")
    below = once.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    once = once.join(below, "key", "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0)))
    once = keep(once.drop("more"), "once")
    own = once.select(
        F.explode(F.concat("up", F.array("key"))).alias("key"),
        (F.col("leaves") + (F.col("children") == 0).cast("long")).alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * F.col("size")).alias("saved"),
    ).groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return keep(once.drop("leaves", "saved", "up").join(own, "key"), "merged")


NODE = ["key", "parent", "depth", "conv", "n", "ends", "children", "leaves", "saved", "parent_conv"]


def _level(rows: DataFrame, above: DataFrame | None, block: int, size: int) -> tuple[DataFrame, DataFrame]:
    """The nodes of the rows' tries, and what their roots pass on: ``prefix, add_children, add_leaves, add_saved``."""
    adds = ["add_children", "add_leaves", "add_saved"]
    if above is not None:
        given = above.select(F.col("prefix").alias("next_prefix"), *adds)
        rows = rows.withColumn("next_prefix", F.when(F.octet_length("path") == block * WIDTH, _end_key(block, full=True)))
        rows = rows.join(given, "next_prefix", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in adds})
    else:
        rows = rows.withColumns({c: F.lit(0).cast("long") for c in adds})
    found = _tries(rows, block, size)
    merged = _merged(found)
    roots = merged.where((F.col("block") > 0) & F.col("parent").isNull())
    roots = roots.select(F.col("key").alias("prefix"), *[F.col(c[4:]).alias(c) for c in adds])
    upper = merged.where((F.col("block") == 0) | F.col("parent").isNotNull()).withColumn("parent_conv", F.lit(None).cast("long"))
    return found.where("not shared").select(*NODE).unionByName(upper.select(*NODE)), roots


def nodes(conversations: DataFrame, block: int = BLOCK, size: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """All nodes with the columns ``NODE`` (``parent_conv`` only where it was at hand), and the blocks they come from."""
    cut = blocks(*rebuilt(turns(conversations)), block)
    rows = _distinct(cut)
    deepest = rows.agg(F.max("block").alias("any"), F.max(F.when(~F.col("alone"), F.col("block"))).alias("shared")).first()
    out, roots = [], None
    if deepest["any"]:
        # blocks of a prefix with one member: every node has one leaf below it and saves nothing
        chains, goes_on = rows.where("alone"), (F.col("n_last") == 0).cast("long")
        found = _tries(chains.withColumns({"add_children": goes_on, "add_leaves": goes_on, "add_saved": F.lit(0).cast("long")}), block, size)
        out.append(found.select(*NODE))
        one = F.lit(1).cast("long")
        roots = chains.select(
            "prefix", one.alias("add_children"), one.alias("add_leaves"), F.lit(0).cast("long").alias("add_saved")
        )
    for level in range(deepest["shared"] or 0, -1, -1):
        found, passed = _level(rows.where((F.col("block") == level) & ~F.col("alone")), roots, block, size)
        out.append(found)
        roots = passed if roots is None else keep(roots.unionByName(passed), "roots")
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return keep(whole, "nodes"), cut


def end_digests(cut: DataFrame, block: int = BLOCK, piece: int = PIECE) -> DataFrame:
    """``key, ends_sha256`` of every node at which a conversation ends."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
            out, start = {"key": [], "first": [], "ids": []}, 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[start] or i - start == piece:
                    out["key"].append(keys[start])
                    out["first"].append(ids[start])
                    out["ids"].append(",".join(map(str, ids[start:i])))
                    start = i
            yield pa.RecordBatch.from_arrays([pa.array(out["key"], pa.binary()), pa.array(out["first"], pa.int64()), pa.array(out["ids"])], ["key", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, running = None, None
        for batch in batches:
            done_keys, done = [], []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if key == own:
                    running.update(b"," + ids.encode())
                    continue
                if own is not None:
                    done_keys.append(own)
                    done.append(running.hexdigest())
                own, running = key, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done_keys, pa.binary()), pa.array(done, pa.string())], ["key", "ends_sha256"])
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own], pa.binary()), pa.array([running.hexdigest()])], ["key", "ends_sha256"])

    rows = cut.where("last").select(_end_key(block).alias("key"), "conv_id")
    rows = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    joined = rows.mapInArrow(pieces, "key binary, first bigint, ids string")
    joined = joined.repartition("key").sortWithinPartitions("key", "first")
    return joined.mapInArrow(digests, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, block: int = BLOCK, size: int = CHUNK, piece: int = PIECE) -> DataFrame:
    """One row per node: ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    found, cut = nodes(conversations, block, size)
    open_ = F.col("parent_conv").isNull() & F.col("parent").isNotNull()
    # parents met in another chunk or block: of the nodes, only those that such a node names are looked up
    asked = found.where(open_).select(F.col("parent").alias("key")).distinct()
    upper = found.join(asked, "key", "left_semi").select(F.col("key").alias("parent"), F.col("conv").alias("upper_conv"))
    whole = found.where(~open_).unionByName(
        found.where(open_).drop("parent_conv").join(upper, "parent").withColumnRenamed("upper_conv", "parent_conv").select(*NODE)
    )
    ended = whole.where("ends").join(end_digests(cut, block, piece), "key")
    rest = whole.where("not ends").withColumn("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    return ended.select(*rest.columns).unionByName(rest).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256",
    )
