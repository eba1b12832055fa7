"""Number parsing and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def half_even(c: Column, places: int) -> Column:
    """Round a double the way numpy does: scale, round half to even, scale back."""
    scale = float(10 ** places)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain number becomes null.

    The pattern guards against type suffixes such as ``5d``, which a cast accepts.
    """
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def at_edge(df: DataFrame) -> DataFrame:
    """Decimals are exact inside a plan; hand doubles to the reader."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])
