"""Numbers by a total order, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.store import keep


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Add ``out``: 0 for the first row in ``order``, 1 for the next, and so on.

    Rows are dealt to partitions by ranges of the order and sorted there. Only one count per
    partition is added up in one place and broadcast. Rows equal in ``order`` get their numbers in any order.
    """
    # the id's lower 33 bits count the rows of a partition, its upper bits the partitions
    dealt = keep(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(out, F.monotonically_increasing_id()), "dealt"
    )
    part = F.shiftrightunsigned(out, 33)
    counts = dealt.groupBy(part.alias("range_part")).agg(F.count(F.lit(1)).alias("range_rows"))
    before = F.sum("range_rows").over(Window.orderBy("range_part")) - F.col("range_rows")
    starts = counts.select("range_part", before.alias("range_start"))
    return (
        dealt.join(F.broadcast(starts), part == F.col("range_part"))
        .withColumn(out, F.col(out).bitwiseAND((1 << 33) - 1) + F.col("range_start"))
        .drop("range_part", "range_start")
    )
