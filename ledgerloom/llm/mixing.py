"""Mixing sources to target weights by entropy balancing.

A document of ``size`` words in a source with ``target`` words to give is taken at the rate ``w`` that
changes the documents least: of all rates from 0 to ``MOST`` with ``sum(w * size) = target``, those for which
``sum(w * ln(w) - w + 1)`` is smallest. The dual of this convex problem has one unknown per source and is solved
where its gradient, words wanted less words taken, is zero; there ``w = min(MOST, exp(tilt * size))``.

Newton's method finds the tilts of all sources at once. A rate depends on source and size alone, so every
iteration is one aggregate over the counts of documents by source and size (a source of ``W`` words has at most
``sqrt(2 * W)`` sizes, however many documents), added up before the shuffle; a step on the logarithm of the words taken
is kept inside a bracket that always holds the solution, so a step too far becomes a bisection. The terms are rounded
and added as whole numbers: the order of additions does not matter and reruns agree to the last bit.

Rates become copies per size: the documents of a source are passed in the order of size, and each size gets as many
copies as bring the copies so far to what the rates say so far, so that they are never apart by one copy or more. What
the words then miss of the target is mended by single copies from large sizes to small, one size per
eighth of an octave; what is left is less than the smallest text, unless one text outweighs all others of its source. Which documents of a size get a copy more is decided by a hash of the row; the ranks come from
slices of the hash, so documents of one size, however many, never meet in one task.

Defined results: a null text has no words. The null source is a source of its own, the last; targets and rates of empty
sources are 0 and 1. Null ids are allowed, repeated rows count and are taken like any other, and equal rows are interchangeable.
No rows, no result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.order import numbered
from ledgerloom.llm.store import keep

WEIGHTS = (5, 2, 1)
#: copies of a document at most
MOST = 3
#: words: white space is space and 09 to 0D
WORD = r"[^\x20\x09-\x0D]+"
SLICES = 4096
#: binary places of a rate, and of the words that it takes of a size
PLACES = 20
#: relative error at which a source counts as balanced
CLOSE = 1e-9
STEPS = 200
#: parts of an octave of sizes in which a size is chosen to mend the words taken
PARTS = 8

SOURCE = ["bare", "source"]


def sizes(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """Narrow rows ``doc_id, bare, source, size, hash``; ``bare`` marks the null source."""
    source = F.col(source_col).cast("string")
    # the table's own names are used once, here
    return keep(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            source.isNull().alias("bare"),
            F.coalesce(source, F.lit("")).alias("source"),
            F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.col(id_col), F.col(text_col)).alias("hash"),
        ),
        "sizes",
    )


def source_totals(cells: DataFrame) -> DataFrame:
    words = F.col("n") * F.col("size")
    return cells.groupBy(*SOURCE).agg(
        F.sum(words).alias("source_size"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"),
        # words per word taken: the size that an average word stands in
        F.sum(words.cast("decimal(38,0)") * F.col("size")).cast("double").alias("squares"),
    )


def shared_targets(totals: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``weight`` and ``target``: all words shared by weight, but no source above ``most`` times its size.

    Sources take the weights in turn, by code point. A round shares what is left among the open sources and closes
    those above their limit; every round but the last closes one at least, usually all of them.
    """
    order = [F.col("bare"), F.col("source")]
    turn = F.array(*map(F.lit, weights))[(F.col("turn") % len(weights)).cast("int")]
    open_ = F.col("closed").isNull()
    state = keep(numbered(totals, order, "turn").withColumns({"weight": turn, "closed": F.lit(None).cast("long")}), "targets")
    while True:
        sums = state.agg(
            F.sum("source_size").alias("all"), F.sum("closed").alias("gone"), F.sum(F.when(open_, F.col("weight"))).alias("weight")
        ).first()
        left = (sums["all"] or 0) - (sums["gone"] or 0)
        share = F.lit(left).cast("double") * F.col("weight") / F.lit(sums["weight"] or 1)
        limit = F.col("source_size") * most
        over = open_ & (share > limit)
        if not state.where(over).take(1):
            return state.withColumn("target", F.coalesce(F.col("closed").cast("double"), share)).drop("turn", "closed")
        state = keep(state.withColumn("closed", F.when(over, limit).otherwise(F.col("closed"))), "targets")


def rate(tilt: Column, size: Column, most: int = MOST) -> Column:
    """``min(most, exp(tilt * size))``, in whole ``2 ** -PLACES``."""
    return F.rint(F.exp(F.least(tilt * size, F.lit(math.log(most)))) * (1 << PLACES)).cast("long")


def balance(cells: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """The tilt of every source: ``bare, source, tilt`` added to ``targets``."""
    total, target, least = F.col("source_size").cast("double"), F.col("target"), F.col("least")
    short = target < total
    top = F.lit(math.log(most))
    none, all_ = F.col("source_size") == 0, target >= total * most * (1 - CLOSE)
    first = F.log(target / total) * total / F.col("squares")
    state = targets.withColumns({
        # at the ends of the bracket: all as small as the least text or unchanged, all unchanged or at the limit
        "low": F.when(none, 0.0).when(short, F.log(target / total) / least).otherwise(0.0),
        "high": F.when(none | short, 0.0).otherwise(2 * top / least),
    }).withColumn("tilt", F.when(none, 0.0).when(all_, F.col("high")).otherwise(F.greatest("low", F.least("high", first))))
    state = keep(state.withColumn("done", none | all_ | (target == total)), "tilts")
    for _ in range(STEPS):
        if not state.where("not done").take(1):
            break
        state = keep(_step(cells, state, top), "tilts")
    return state.drop("low", "high", "done", "least", "squares")


def _step(cells: DataFrame, state: DataFrame, top: Column) -> DataFrame:
    """One Newton step for the sources that are not balanced yet."""
    reach = F.col("tilt") * F.col("size")
    words = F.exp(F.least(reach, top)) * F.col("n") * F.col("size")

    def whole(c: Column) -> Column:
        return F.sum(F.rint(c * (1 << PLACES)).cast("decimal(38,0)")).cast("double") / (1 << PLACES)

    taken = (
        cells.join(state.where("not done").select(*SOURCE, "tilt"), SOURCE)
        .groupBy(*SOURCE).agg(whole(words).alias("taken"), whole(F.when(reach < top, words * F.col("size")).otherwise(0.0)).alias("slope"))
    )
    f, target = F.col("taken"), F.col("target")
    low, high = F.when(f < target, F.col("tilt")).otherwise(F.col("low")), F.when(f > target, F.col("tilt")).otherwise(F.col("high"))
    newton = F.when((F.col("slope") > 0) & (f > 0), F.col("tilt") - F.log(f / target) * f / F.col("slope"))
    middle = (F.col("low_") + F.col("high_")) / 2
    inside = (F.col("newton") > F.col("low_")) & (F.col("newton") < F.col("high_"))
    close = (F.abs(f - target) <= target * CLOSE) | (F.abs(F.col("high_") - F.col("low_")) <= F.abs(F.col("high_")) * 1e-15)
    moved = (
        state.join(taken, SOURCE, "left")
        .withColumns({"low_": low, "high_": high, "newton": newton})
        .withColumn("end", F.col("done") | F.coalesce(close, F.lit(False)))
        .withColumn("next", F.when(F.col("end"), F.col("tilt")).when(inside, F.col("newton")).otherwise(middle))
    )
    kept = [c for c in state.columns if c not in ("low", "high", "tilt", "done")]
    return moved.select(
        *kept,
        F.when(F.col("done"), F.col("low")).otherwise(F.col("low_")).alias("low"),
        F.when(F.col("done"), F.col("high")).otherwise(F.col("high_")).alias("high"),
        F.col("next").alias("tilt"),
        F.col("end").alias("done"),
    )


def cell_copies(cells: DataFrame, tilts: DataFrame, most: int = MOST) -> DataFrame:
    """Copies of all documents of one source and size together: ``copies`` added to the cells."""
    rated = cells.join(tilts.select(*SOURCE, "source_size", "target", "tilt"), SOURCE).withColumn(
        "wanted", F.col("n") * rate(F.col("tilt"), F.col("size"), most)
    )
    so_far = F.sum("wanted").over(Window.partitionBy(*SOURCE).orderBy("size"))
    rounded = keep(
        rated.withColumn("so_far", so_far).withColumn(
            "copies", F.shiftright("so_far", PLACES) - F.shiftright(F.col("so_far") - F.col("wanted"), PLACES)
        ).drop("so_far", "wanted"),
        "rounded",
    )
    fixes = _fixes(rounded, most)
    mended = F.col("copies") + F.coalesce(F.col("fix"), F.lit(0))
    return rounded.join(fixes, [*SOURCE, "size"], "left").withColumn("copies", mended).drop("fix", "tilt")


def _fixes(rounded: DataFrame, most: int) -> DataFrame:
    """Copies to add or take away (``bare, source, size, fix``) so that a source's words come to its target."""
    words = rounded.groupBy(*SOURCE).agg(
        (F.rint(F.first("target")).cast("long") - F.sum(F.col("copies") * F.col("size"))).alias("missing")
    )
    able = rounded.join(words.where("missing != 0"), SOURCE).where("size > 0")
    room = F.when(F.col("missing") > 0, F.col("n") * most - F.col("copies")).otherwise(F.col("copies"))
    octave = F.floor(F.log2(F.col("size").cast("double")) * PARTS)
    # the smallest size of each part of an octave with room: at most 63 * PARTS to a source
    chosen = (
        able.withColumn("room", room).where("room > 0").groupBy(*SOURCE, "missing", octave.alias("octave"))
        .agg(F.min_by(F.struct("size", "room"), "size").alias("place"))
        .groupBy(*SOURCE, "missing").agg(F.sort_array(F.collect_list("place"), asc=False).alias("places"))
    )
    kind = "array<struct<size:bigint,fix:bigint>>"
    fold = f"""aggregate(places, struct(abs(missing) as left, cast(array() as {kind}) as fixes), (s, p) -> struct(
        s.left - least(p.room, s.left div p.size) * p.size as left,
        concat(s.fixes, array(struct(p.size as size, least(p.room, s.left div p.size) * sign_ as fix))) as fixes), s -> s.fixes)"""
    sign = F.when(F.col("missing") > 0, F.lit(1)).otherwise(F.lit(-1)).cast("long")
    return (
        chosen.withColumn("sign_", sign).select(*SOURCE, F.explode(F.expr(fold)).alias("f"))
        .select(*SOURCE, "f.*").where("fix != 0")
    )


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``; ``taken`` is copies times size."""
    rows = sizes(docs, id_col, text_col, source_col).withColumn("slice", F.pmod("hash", F.lit(SLICES)))
    slices = keep(rows.groupBy(*SOURCE, "size", "slice").agg(F.count(F.lit(1)).alias("slice_n")), "slices")
    cells = keep(slices.groupBy(*SOURCE, "size").agg(F.sum("slice_n").alias("n")), "cells")
    tilts = balance(cells, shared_targets(source_totals(cells), weights, most), most)
    copies = cell_copies(cells, tilts, most)
    # of a size's copies that are not the same for all, the first slices get theirs first
    before = F.sum("slice_n").over(Window.partitionBy(*SOURCE, "size").orderBy("slice")) - F.col("slice_n")
    dealt = slices.withColumn("before", before).join(copies, [*SOURCE, "size"]).select(
        *SOURCE, "size", "slice", "source_size", "target",
        F.expr("copies div n").alias("each"), (F.expr("copies % n") - F.col("before")).alias("more"),
    )
    place = F.row_number().over(Window.partitionBy(*SOURCE, "size", "slice").orderBy("hash", "doc_id"))
    out = rows.join(dealt, [*SOURCE, "size", "slice"]).withColumn(
        "copies", F.col("each") + F.when(place <= F.col("more"), 1).otherwise(0)
    )
    return out.select(
        "doc_id", F.when(~F.col("bare"), F.col("source")).alias("source"), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
