"""Best-fit packing of tokenised documents by the sum-of-squares rule.

``N(g)`` is the number of open sequences with room for ``g`` more tokens. A piece of ``s`` tokens
goes into the open sequence of the gap ``g >= s`` for which ``sum(N(g)**2)`` becomes smallest; full
sequences do not count, ties go to the smallest gap, and a new sequence is opened only where no
open one has room. Keeping the counts low and even leaves no gap behind that few pieces fit.

Pieces are dealt at random to shards of bounded size; every shard is packed on its own, long
pieces first. What a shard leaves in sequences that are not nearly full is packed again together
with the leavings of the others, so the cost of sharding does not grow with their number.

Defined results: a null or empty text is one piece with only the end id. Repeated rows and null
ids are packed like any other row. Only documents longer than a sequence are cut, into pieces of
full length; the last piece may be shorter. No tokens are dropped, no place is shared.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import keep
from ledgerloom.llm.tokens import tokenizer

#: pieces in a shard, about; bounds the memory of a task
SHARD = 16_384
#: sequences filled less than this go to the second round
NEARLY_FULL = 0.995

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, bytes]]:
    """Number, first id and ids of each piece of a document."""
    width = 4 * capacity
    for n, at in enumerate(range(0, len(ids), width)):
        yield n, at // 4, ids[at : at + width]


def pieces(
    docs: DataFrame, path: str, kind: str, capacity: int, id_col="doc_id", text_col="text", end_id=0, with_ids=False
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if wanted, ``ids``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path, kind)
        for batch in batches:
            texts = (t.as_py() for t in batch.column("body"))
            rows = [
                (i, n, at, len(part) // 4, zlib.crc32(part), part if with_ids else b"")
                for i, ids in enumerate(coder.encode(texts))
                for n, at, part in cut(ids + end, capacity)
            ]
            row, n, at, length, crc, part = zip(*rows) if rows else [()] * 6
            out = {
                "doc_id": batch.column("id").take(pa.array(row, pa.int64())),
                "piece": pa.array(n, pa.int32()),
                "start": pa.array(at, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(part, pa.binary())} if with_ids else {}))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    return rows.mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, packed in the order given."""
    count = np.zeros(capacity + 1, dtype=np.int64)  # open sequences by gap; N(0) stays 0
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = np.empty(len(sizes), dtype=np.int64)
    offset = np.empty(len(sizes), dtype=np.int64)
    made = 0
    never = np.iinfo(np.int64).max
    for i, s in enumerate(sizes.tolist()):
        fits, then = count[s:capacity], count[: capacity - s]
        # change of the sum: a sequence leaves gap g (1 - 2 N(g)) and comes to g - s (1 + 2 N(g - s))
        change = 2 + 2 * (then - fits)
        change[:1] -= 1  # a sequence that becomes full leaves the sum
        change[fits == 0] = never
        best = int(change.argmin()) if s < capacity else 0
        if s < capacity and change[best] < never:
            gap = s + best
            number = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, number = capacity, made
            made += 1
        sequence[i], offset[i] = number, capacity - gap
        if gap > s:
            open_at[gap - s].append(number)
            count[gap - s] += 1
    return sequence, offset


def pack(items: DataFrame, capacity: int, length_col: str = "length", shard: int = SHARD) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a length of 1 to ``capacity``."""
    numbered = keep(items.withColumn("pack_row", F.monotonically_increasing_id()), "items")
    small = numbered.select("pack_row", F.col(length_col).cast("int").alias("size"))
    first = keep(_round(small, capacity, shard, 0), "packed")
    fill = first.groupBy("sequence_id").agg(F.sum("size").alias("fill"))
    slack = fill.where(F.col("fill") < int(capacity * NEARLY_FULL)).select("sequence_id")
    again = keep(first.join(slack, "sequence_id", "left_semi").select("pack_row", "size"), "slack")
    second = _round(again, capacity, shard, 1)
    done = first.join(slack, "sequence_id", "left_anti").unionByName(second)
    return numbered.join(done.drop("size"), "pack_row").drop("pack_row")


def _round(items: DataFrame, capacity: int, shard: int, number: int) -> DataFrame:
    n = max(1, -(-items.count() // shard))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "pack_row"], ascending=[False, True], ignore_index=True)
        sequence, offset = sum_of_squares(group["size"].to_numpy(), capacity)
        # rounds take even and odd numbers, shards blocks of 2**32
        group["sequence_id"] = (int(group["shard"].iloc[0]) * 2**32 + sequence) * 2 + number
        group["offset"] = offset
        return group[["pack_row", "size", "sequence_id", "offset"]]

    return (
        items.withColumn("shard", F.pmod(F.xxhash64("pack_row", F.lit(number)), F.lit(n)))
        .groupBy("shard")
        .applyInPandas(run, "pack_row bigint, size int, sequence_id bigint, offset bigint")
    )
