"""Duplicate and nearly equal lines by a segment-partition edit join; DataFrame operations only.

Lines are what stands between line feeds, unchanged. Equal lines are one node. Nodes are linked when
their edit distance is at most ``edits_allowed`` of the shorter one: ``EDITS`` from ``SHORTEST``
characters on, one from ``ONE_EDIT`` on, none below (very short words would all be alike).

A line of ``SHORTEST`` characters or more is cut into ``EDITS + 1`` segments of almost equal length; of two lines within ``EDITS``
edits, one has a segment that the other contains, moved by no more than the edits allow. Segments
are indexed under their number and the length of their line; a longer (or equally long) line looks
up, for each length that may match, just those of its substrings that the edits left and right
of a segment permit. Lines that may differ by one edit
are few characters long, so segments would say little: they are looked up without each of their
characters in turn, under its place for a line of the same length, and as a whole for a line that has
one less. Candidates whose counts of characters by class differ by more than ``EDITS``
edits can explain are passed over. The rest are decided by a banded bit-parallel
edit distance: a column of the distance table is held as bits, ``2 * EDITS + 1`` of them, and moves
down the diagonal with each character.

Classes are connected components; of each class the first line stays, by document id and line
number. For classes (``line_classes``) only pairs that could join two of them are compared, so a group of
near copies does not form all its pairs; ``line_links`` returns every link between different lines.

Defined results: a null text is one empty line. Lines shorter than ``ONE_EDIT`` are only linked when
they are equal. Equal lines are told by
two 64-bit hashes. Repeated rows give rows each, all of them marked like the first. A null id is
larger than any other. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.graph import components
from ledgerloom.llm.store import free, keep

EDITS = 2
SHORTEST = 13
ONE_EDIT = 5

#: characters counted together
CLASSES = ("e", "t", "n", "i", "a", "ro", "sh", "ldu")


def edits_allowed(shorter: Column) -> Column:
    """Edits by which two lines may differ, by the length of the shorter one."""
    return F.when(shorter >= SHORTEST, EDITS).when(shorter >= ONE_EDIT, 1).otherwise(0)


def _segment(length: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 0) and length of segment ``i`` of a line; the longer segments come last."""
    parts = EDITS + 1
    base, more = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    extra = F.greatest(F.lit(0), i - parts + more)
    return base * i + extra, base + F.when(i >= F.lit(parts) - more, 1).otherwise(0)


def _key(line: Column, length: Column, i: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(i, length, F.substring(line, start + 1, size))


def index_keys(line: Column, length: Column) -> list[Column]:
    return [_key(line, length, F.lit(i), *_segment(length, F.lit(i))) for i in range(EDITS + 1)]


def look_ups() -> Column:
    """All look-ups of a line: how much shorter the other line is, its segment, and how far that has moved."""
    found = []
    for shorter in range(EDITS + 1):
        for i in range(EDITS + 1):
            first = max(-i, shorter - (EDITS - i))
            last = min(i, shorter + (EDITS - i))
            found += [(shorter, i, move) for move in range(first, last + 1)]
    return F.array(*[
        F.struct(F.lit(shorter).alias("shorter"), F.lit(i).alias("i"), F.lit(move).alias("move"))
        for shorter, i, move in found
    ])


def probe_key(line: Column, length: Column, look_up: Column) -> Column:
    """The key of one of ``look_ups``; null where the other line or its segment cannot be."""
    other, move = length - look_up["shorter"], look_up["move"]
    start, size = _segment(other, look_up["i"])
    fits = (other >= SHORTEST) & (start + move >= 0) & (start + move + size <= length)
    return F.when(fits, _key(line, other, look_up["i"], start + move, size))


def _without_each(line: Column, length: Column, key) -> Column:
    """``key(place, rest)`` for each character, ``rest`` being the line without it."""
    return F.transform(
        F.sequence(F.lit(1), length),
        lambda p: key(p, F.concat(F.substring(line, F.lit(1), p - 1), F.substring(line, p + 1, length))),
    )


def short_index_keys(line: Column, length: Column) -> Column:
    """Keys of a line that one edit may change: the whole line, and what is left without each character."""
    rests = _without_each(line, length, lambda p, rest: F.xxhash64(p, length, rest))
    return F.concat(F.array(F.xxhash64(F.lit(0), length, line)), rests)


def short_probe_keys(line: Column, length: Column) -> Column:
    """How much shorter the line looked for is, and the key to look up, for lines that one edit may change."""

    def found(shorter: int, key: Column) -> Column:
        return F.struct(F.lit(shorter).alias("shorter"), key.alias("key"))

    return F.concat(
        _without_each(line, length, lambda p, rest: found(0, F.when(length < SHORTEST, F.xxhash64(p, length, rest)))),
        _without_each(
            line, length, lambda p, rest: found(1, F.when(length > ONE_EDIT, F.xxhash64(F.lit(0), length - 1, rest)))
        ),
    )


def class_counts(line: Column) -> Column:
    """Characters by class, eight counts modulo 256 in a long."""

    def without(chars: str) -> Column:
        return reduce(lambda left, c: F.replace(left, F.lit(c)), chars, line)

    counts = [(F.length(line) - F.length(without(chars))) % 256 for chars in CLASSES]
    return reduce(
        lambda a, b: a.bitwiseOR(b), [F.shiftleft(c.cast("long"), 8 * k) for k, c in enumerate(counts)]
    )


def counts_apart(a: Column, b: Column) -> Column:
    def one(k: int) -> Column:
        gap = F.abs(F.shiftright(a, 8 * k).bitwiseAND(F.lit(255)) - F.shiftright(b, 8 * k).bitwiseAND(F.lit(255)))
        return F.least(gap, 256 - gap)

    return reduce(lambda x, y: x + y, [one(k) for k in range(len(CLASSES))])


def banded_distance(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Edit distance of two arrays of characters whose lengths differ by ``edits`` at most.

    Exact up to ``edits``, larger than ``edits`` beyond. ``a`` has ``edits`` elements or more. In
    column ``j`` bit ``k`` stands for row ``j - edits + k``; ``up`` and ``down`` mark rows whose value
    is one more or less than the row above, ``level`` rows equal to their upper left neighbour.
    """
    # an array that is given as an expression would be made anew for every element
    return _let(F.struct(a.alias("a"), b.alias("b")), lambda pair: _banded(pair["a"], pair["b"], edits))


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.transform(F.array(value), then)[0]


def _banded(a: Column, b: Column, edits: int) -> Column:
    width = 2 * edits + 1
    full = F.lit((1 << width) - 1)
    n = F.size(a)

    def flip(x: Column) -> Column:
        return x.bitwiseXOR(full)

    def bit(x: Column, k: Column) -> Column:
        return F.call_function("shiftright", x, k).bitwiseAND(F.lit(1))

    def column(state: Column, j: Column) -> Column:
        up, down = state["up"], state["down"]

        def step(level: Column, right_up: Column, right_down: Column) -> Column:
            below = F.shiftright(level, 1)
            # along the lowest diagonal of the band down to the last row, then along that row
            last = n - j + edits
            more = F.when(j + edits <= n, 1 - F.shiftright(level, width - 1)).otherwise(
                bit(right_up, last) - bit(right_down, last)
            )
            return F.struct(
                right_down.bitwiseOR(flip(below.bitwiseOR(right_up))).alias("up"),
                below.bitwiseAND(right_up).alias("down"),
                (state["distance"] + more).alias("distance"),
            )

        char = F.get(b, j - 1)
        same = [F.when(F.get(a, j - 1 - edits + k) == char, 1 << k).otherwise(0) for k in range(width)]
        return _let(
            reduce(lambda x, y: x + y, same),
            lambda eq: _let(
                (eq.bitwiseAND(up) + up).bitwiseXOR(up).bitwiseOR(eq).bitwiseOR(down).bitwiseAND(full),
                lambda level: _let(
                    down.bitwiseOR(flip(level.bitwiseOR(up))),
                    lambda right_up: step(level, right_up, level.bitwiseAND(up)),
                ),
            ),
        )

    start = F.struct(
        F.lit((((1 << (edits + 1)) - 1) << edits)).alias("up"), F.lit(0).alias("down"), F.lit(edits).alias("distance")
    )
    return F.aggregate(F.sequence(F.lit(1), F.size(b)), start, column)["distance"]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    parts = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.posexplode(parts).alias("line_no", "line")).select(
        "doc", "line_no", "line", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(7), F.col("line")).alias("g")
    )


def measured(nodes: DataFrame) -> DataFrame:
    """Add the length of ``line``, which every key needs."""
    return nodes.withColumn("n", F.length("line"))


def edit_buckets(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Buckets of rows of ``node, line, n`` (distinct lines, ``measured``) and the lines that are in one.

    A bucket is an index key: ``key, node, owner, low, high`` for every node that looks it up, ``owner`` if
    it is also indexed there, ``low`` and ``high`` being the first and last indexed node. A node alone in its
    bucket is left out. Any two lines within the edits allowed are in one bucket, at least one of them indexed.
    """
    length = F.col("n")  # a column, so that characters are counted once and not for every key
    line = F.col("line")
    long = nodes.where(length >= ONE_EDIT)
    # keys are exploded before anything is shuffled; texts stay behind
    own = F.when(length >= SHORTEST, F.array(*index_keys(line, length))).otherwise(short_index_keys(line, length))
    ends = long.select("node", F.explode(own).alias("key")).groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    # a row per look-up first: one expression for the key instead of one for each look-up
    moved = long.where(length >= SHORTEST).select("node", "line", "n", F.explode(look_ups()).alias("l"))
    same = (F.col("l.shorter") == 0) & (F.col("l.move") == 0)
    moved = moved.select("node", same.alias("owner"), probe_key(line, length, F.col("l")).alias("key"))
    # of lines of SHORTEST characters, those with one less are looked for as short ones
    short = long.where(length <= SHORTEST).select("node", F.explode(short_probe_keys(line, length)).alias("p"))
    short = short.select("node", (F.col("p.shorter") == 0).alias("owner"), "p.key")
    probed = moved.unionByName(short).where("key is not null")
    buckets = keep(probed.join(ends, "key").where("node != low or low != high"), "line-buckets")
    free(nodes.sparkSession)
    met = buckets.select("node").unionByName(buckets.select(F.col("low").alias("node"))).distinct()
    # shuffled at every size: what is met grows with the lines
    texts = nodes.select("node", "line").join(met.hint("merge"), "node", "left_semi")
    texts = keep(texts.withColumn("counts", class_counts(line)), "line-texts")
    free(nodes.sparkSession)
    return buckets, texts


def _pairs(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("x"), F.greatest(x, y).alias("y")]


def _within(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs ``x, y`` that are within the edits allowed."""

    def side(name: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("line", "counts")])

    distance = banded_distance(F.split("x_line", ""), F.split("y_line", ""))
    allowed = edits_allowed(F.least(F.length("x_line"), F.length("y_line")))
    both = pairs.join(side("x"), "x").join(side("y"), "y")
    return both.where(counts_apart(F.col("x_counts"), F.col("y_counts")) <= 2 * EDITS).where(distance <= allowed).select("x", "y")


def edit_links(nodes: DataFrame) -> DataFrame:
    """All links ``x, y`` between rows of ``node, line, n`` within the edits allowed.

    As many as there are: of a group of lines that are all alike, that is every pair.
    """
    buckets, texts = edit_buckets(nodes)
    whole = buckets.where("node != low").select(*_pairs(F.col("node"), F.col("low")))
    u, v = buckets.alias("u"), buckets.where("owner").alias("v")
    inner = u.join(v, F.col("u.key") == F.col("v.key")).where("u.node != v.node")
    return _within(whole.unionByName(inner.select(*_pairs(F.col("u.node"), F.col("v.node")))).distinct(), texts)


def class_links(nodes: DataFrame) -> DataFrame:
    """Links ``x, y`` that make the same classes as all ``edit_links`` do, without every pair of a class.

    In each bucket all nodes are compared with its first indexed node, then those of other classes with
    its last one, and only then what is still apart with each other.
    """
    buckets, texts = edit_buckets(nodes)
    found = keep(_within(buckets.where("node != low").select(*_pairs(F.col("node"), F.col("low"))).distinct(), texts), "line-found")
    # a bucket with one indexed node has been compared in full
    rows = buckets.where("low != high")
    for last in (False, True):
        named = rows.join(components(found), "node", "left").withColumn("component", F.coalesce("component", "node"))
        apart = named.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
        named = keep(named.join(apart.select("key"), "key").join(texts.select("node", "counts"), "node"), "line-named")
        u, v = named.alias("u"), named.where("owner").alias("v")
        if last:  # with the first and the last node all others have been compared
            u, v = (side.where("node != low and node != high").alias(name) for side, name in ((u, "u"), (v, "v")))
        else:
            v = v.where("node = high").alias("v")
        pairs = (
            u.join(v, F.col("u.key") == F.col("v.key"))
            .where("u.component != v.component and (u.node < v.node or v.node = v.high or not u.owner)")
            .where(counts_apart(F.col("u.counts"), F.col("v.counts")) <= 2 * EDITS)
        )
        more = _within(pairs.select(*_pairs(F.col("u.node"), F.col("v.node"))).distinct(), texts)
        found = keep(found.unionByName(more), "line-found")
        free(nodes.sparkSession)
    return found


def _nodes(rows: DataFrame) -> DataFrame:
    """``h, g, first, line, n, node`` per distinct line, from its first row."""
    # the line goes along with its place, so lines are shuffled once and copies are combined before
    whole = F.struct(F.col("doc").isNull().alias("none"), "doc", "line_no", "line")
    least = rows.groupBy("h", "g").agg(F.min(whole).alias("least"))
    first = F.struct("least.none", "least.doc", "least.line_no")
    nodes = least.select("h", "g", first.alias("first"), F.col("least.line").alias("line"))
    nodes = keep(measured(nodes).withColumn("node", F.monotonically_increasing_id()), "line-nodes")
    free(rows.sparkSession)
    return nodes


def line_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per link between two different lines, each known by its first place: ``doc_id, line_no, other_doc_id, other_line_no``.

    The result holds every pair within the edits allowed once, and so grows with the square of a group that is all alike.
    """
    nodes = _nodes(_rows(docs, id_col, text_col))
    found = edit_links(nodes.select("node", "line", "n"))

    def side(name: str, prefix: str) -> DataFrame:
        first = F.col("first")
        return nodes.select(
            F.col("node").alias(name), first["doc"].alias(f"{prefix}doc_id"), first["line_no"].alias(f"{prefix}line_no")
        )

    return found.join(side("x", ""), "x").join(side("y", "other_"), "y").drop("x", "y")


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line: ``doc_id, line_no, class_doc_id, class_line_no, kept``.

    The class is named by its first line. ``line_links`` gives the links themselves.
    """
    rows = _rows(docs, id_col, text_col)
    nodes = _nodes(rows)
    names = components(class_links(nodes.select("node", "line", "n")))
    linked = nodes.select("node", "h", "g", "first").join(names, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    lead = linked.groupBy("component").agg(F.min("first").alias("lead"))
    known = keep(linked.join(lead, "component").select("h", "g", "lead"), "line-classes")
    return rows.drop("line").join(known, ["h", "g"]).select(
        F.col("doc").alias("doc_id"),
        "line_no",
        F.col("lead.doc").alias("class_doc_id"),
        F.col("lead.line_no").alias("class_line_no"),
        (F.col("doc").eqNullSafe(F.col("lead.doc")) & (F.col("line_no") == F.col("lead.line_no"))).alias("kept"),
    )
