"""Column types of text tables, settled for each file on its own.

Every value has a kind; a column's kind is that of all its values together: nothing at all, whole
numbers, numbers, truth values, days, or text as soon as kinds do not go together. Kinds are bits, so those of
two halves of a file are combined with a bitwise or, and one aggregate over any number of files does it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.numeric import PLAIN_NUMBER

WHOLE, NUMBER, TRUTH, DAY, TEXT = 1, 2, 4, 8, 16

#: a leading zero or more digits than a long holds make an id of a number, and ids stay text
WHOLE_SHAPE = r"^[-+]?(0|[1-9]\d{0,17})$"
ID_SHAPE = r"^[-+]?0\d"
DAY_SHAPE = r"^\d{4}-\d{2}-\d{2}\z"


def kind_of(c: Column) -> Column:
    """The kind of one value; null has none.

    Numbers and days begin with a sign, a dot or a digit, which lie between ``+`` and ``9``: other text is told without a pattern.
    """
    numeric = (
        F.when(c.rlike(WHOLE_SHAPE), WHOLE)
        .when(c.rlike(PLAIN_NUMBER) & ~c.rlike(ID_SHAPE) & ~c.rlike(r"^[-+]?\d{19,}$"), NUMBER)
        .when(c.rlike(DAY_SHAPE) & c.try_cast("date").isNotNull(), DAY)
        .otherwise(TEXT)
    )
    return (
        F.when(c.isNull(), 0)
        .when(is_plain_text(c), TEXT)
        .when((c >= "+") & (c < ":"), numeric)
        .otherwise(TRUTH)
    )


def is_plain_text(c: Column) -> Column:
    """Whether a value is text by its first character, no truth value, and so needs no pattern; null is not."""
    return F.when((c >= "+") & (c < ":"), False).otherwise(c.isNotNull() & ~F.lower(c).isin("true", "false"))


def type_of(kinds: int) -> str:
    """The Spark type of a column with these kinds of values; text where it has none."""
    return {WHOLE: "bigint", NUMBER: "double", WHOLE | NUMBER: "double", TRUTH: "boolean", DAY: "date"}.get(kinds, "string")


def column_kinds(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``by`` and an array of the kinds of ``columns``: one row per file, whatever its size."""
    kinds = [F.bit_or(kind_of(F.col(f"`{c}`"))).alias(f"_kind_{i}") for i, c in enumerate(columns)]
    found = df.groupBy(*by).agg(*kinds)
    return found.select(*by, F.array(*[F.col(f"_kind_{i}") for i in range(len(columns))]).alias("kinds"))
