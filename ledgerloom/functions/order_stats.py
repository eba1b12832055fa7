"""Exact global ranks and exact quantiles without pulling a column into one task.

Both count equal values first (map-side combine collapses hot values) and then place the
values into order-preserving buckets: the exponent of the double (its octave) and the leading bits of its
fraction. Values that crowd around any number, near zero or far from it, are told apart as long as
they differ in their first five digits or so. Counts are added up in two levels, over the octaves and inside
each octave, so that no task sees all buckets.

Infinities have a bucket each, at the ends. NaN is a missing value to quantiles, and comes after infinity in ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

PARTS_OF_OCTAVE = 1 << 16
LOWEST_EXPONENT = -1074
# whole octaves behind all finite values
INFINITE_BUCKET = (1024 - LOWEST_EXPONENT + 1) * PARTS_OF_OCTAVE
NAN_BUCKET = INFINITE_BUCKET + PARTS_OF_OCTAVE
NULL_BUCKET = NAN_BUCKET + PARTS_OF_OCTAVE


def order_bucket(value: Column) -> Column:
    """An integer that never decreases as ``value`` grows."""
    x = value.cast("double")
    infinite = F.abs(x) == F.lit(float("inf"))
    size = F.when(~infinite & ~F.isnan(x), F.abs(x))
    octave = F.floor(F.log2(size))
    # a logarithm rounded up at an octave's edge gives a part of -1: the same bucket
    part = F.floor((size / F.pow(F.lit(2.0), octave) - 1) * PARTS_OF_OCTAVE)
    bucket = (octave - LOWEST_EXPONENT) * PARTS_OF_OCTAVE + part + 1
    return F.when(F.isnan(x), NAN_BUCKET).when(infinite, F.signum(x) * INFINITE_BUCKET).when(x == 0, 0).otherwise(
        F.signum(x) * bucket).cast("int")


def with_starts(buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_before``, the count in the buckets before, and ``n``, the count in all, to (keys, ``_b``, ``_bc``)."""
    octaves = buckets.withColumn("_o", F.floor(F.col("_b") / PARTS_OF_OCTAVE).cast("int"))
    whole = Window.partitionBy(*keys)
    totals = octaves.groupBy(*keys, "_o").agg(F.sum("_bc").alias("_oc")).select(
        *keys, "_o", (F.sum("_oc").over(whole.orderBy("_o")) - F.col("_oc")).alias("_ob"), F.sum("_oc").over(whole).alias("n"))
    inside = Window.partitionBy(*keys, "_o").orderBy("_b")
    placed = octaves.withColumn("_in", F.sum("_bc").over(inside) - F.col("_bc"))
    return placed.alias("f").join(totals.alias("o"), same_key("f", "o", [*keys, "_o"])).select(
        *[F.col(f"f.{k}").alias(k) for k in keys], "_b", "_bc", (F.col("_ob") + F.col("_in")).alias("_before"), "n")


def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    match = F.lit(True)
    for k in keys:
        match = match & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return match


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return (
        df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str], probs: Sequence[float], out: str) -> DataFrame:
    """Linear-interpolated quantiles of each group of ``(keys, _v, _c)``.

    Result: keys, ``out`` (array of doubles, one per probability) and ``n``.
    """
    keys = list(keys)
    binned = counts.withColumn("_b", order_bucket(F.col("_v")))
    buckets = with_starts(binned.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc")), keys)
    # zero-based position of each quantile between two neighbouring ranks
    spots = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    low = [F.floor(s) for s in spots]
    high = [F.ceil(s) for s in spots]
    inside = F.lit(False)
    for k in low + high:
        inside = inside | ((k >= F.col("_before")) & (k < F.col("_before") + F.col("_bc")))
    wanted = buckets.filter(inside)
    in_bucket = Window.partitionBy(*keys, "_b").orderBy("_v")
    joined = (
        binned.alias("h").join(wanted.alias("w"), same_key("h", "w", [*keys, "_b"]))
        .select("h.*", "w._before", "w.n")
        .withColumn("_end", F.col("_before") + F.sum("_c").over(in_bucket))
        .withColumn("_start", F.col("_end") - F.col("_c"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_start")) & (rank < F.col("_end")), F.col("_v")))

    picked = joined.groupBy(*keys, "n").agg(
        *[at(k).alias(f"_l{i}") for i, k in enumerate(low)],
        *[at(k).alias(f"_h{i}") for i, k in enumerate(high)],
    )
    # equal neighbours are not interpolated: between infinities that would give NaN
    values = [
        F.when(F.col(f"_l{i}") == F.col(f"_h{i}"), F.col(f"_l{i}")).otherwise(
            F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * (spots[i] - low[i])) for i in range(len(probs))
    ]
    return picked.select(*keys, F.array(*values).alias(out), "n")


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], out: str = "q") -> DataFrame:
    return quantiles_of_counts(value_counts(df, keys, value), keys, probs, out)


def medians(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return quantiles(df, keys, value, [0.5], "_q").select(*keys, F.col("_q")[0].alias(out))


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``(column, median)`` per numeric column, all columns in one pass."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("x")).select("x.*")
    return medians(long, ["column"], "value", "median")


def with_rank(df: DataFrame, value: str, id_col: str, out: str) -> DataFrame:
    """Rank 1..n by ``value``; ties in the order of ``md5(id)``, then id. Nulls come last.

    A value held by a large part of the rows is spread over 256 slices by the first two
    digits of the hash, so neither the join nor the numbering meets a hot key.
    """
    keyed = df.withColumn("_h", F.md5(F.col(id_col).cast("string"))).withColumn("_s", F.substring("_h", 1, 2))
    slices = keyed.groupBy(value, "_s").agg(F.count(F.lit(1)).alias("_c"))
    slices = slices.withColumn("_b", F.coalesce(order_bucket(F.col(value)), F.lit(NULL_BUCKET)))
    in_bucket = Window.partitionBy("_b").orderBy(value, "_s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = slices.withColumn("_end", F.sum("_c").over(in_bucket))
    starts = with_starts(slices.groupBy("_b").agg(F.sum("_c").alias("_bc")), []).select("_b", "_before")
    offsets = slices.join(starts, "_b").select(
        F.col(value).alias("_val"), F.col("_s").alias("_sl"),
        (F.col("_before") + F.col("_end") - F.col("_c")).alias("_off"))
    numbered = Window.partitionBy(value, "_s").orderBy("_h", id_col)
    return (
        keyed.join(offsets, F.col(value).eqNullSafe(F.col("_val")) & (F.col("_s") == F.col("_sl")))
        .withColumn(out, F.col("_off") + F.row_number().over(numbered))
        .drop("_h", "_s", "_val", "_sl", "_off")
    )


def level(rank: Column, n: Column, levels: int = 5, reverse: bool = False) -> Column:
    """``ceil(levels * rank / n)`` in whole numbers, kept within 1..levels."""
    top = (n - rank) if reverse else rank
    scaled = F.floor((top * levels + n - 1) / n).cast("int")
    return F.greatest(F.lit(1), F.least(F.lit(levels), scaled))
