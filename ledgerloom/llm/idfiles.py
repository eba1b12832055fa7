"""Files of token ids: every document's ids in ascending order of the document ids.

A file is a row of blocks of up to ``rangecoder.BLOCK`` ids each, coded independently of each
other and with checksums of their own, a table of the file's documents, and a trailer:

* ``LLIDS003``
* per block ``BLK1``, number of ids, bytes, CRC-32 of the bytes, CRC-32 of the ids (little-endian
  unsigned 32-bit), then the bytes; a block with an id above 65,535 is marked ``BLK2``, and its bytes are
  the number of bytes that code the lower 16 bits of its ids, those, and those of the upper 16 bits
* after up to ``GROUP`` blocks ``SHR1``, bytes and CRC-32, then deflated: how often, of 65,536, each of 65,536 lower
  halves of ids is dealt a share in these blocks, and the same of the upper halves if a block is marked ``BLK2``
* ``DOCS``, bytes and CRC-32, then deflated: number of documents, and for each whether its id is
  not null, its id, and its number of ids
* offset of ``DOCS`` and ``LLIDS003``

A damaged block is told by its checksums and costs only its own ids, damaged shares those of their group. Documents are dealt to files by
ranges of their ids; a table lists the files in order. Tasks choose new names, and a file of a
lost task is in no table.

Defined results: a null text has only the end id. Null ids come first. Rows with equal ids stand next
to each other, in the order of a hash of their texts; equal rows give equal documents. Ids are of
32 bits. An empty input gives no files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import rangecoder
from ledgerloom.llm.store import keep, new_folder, open_folder
from ledgerloom.llm.tokens import tokenizer

MAGIC = b"LLIDS003"
#: blocks coded side by side; bounds a task's memory
GROUP = 2048
_HEAD = struct.Struct("<4sIIII")
_TABLE = struct.Struct("<4sII")
_TRAILER = struct.Struct("<Q8s")


class Writer:
    def __init__(self, stream):
        self.stream, self.offset, self.total = stream, 0, 0
        self.docs: list[tuple[bool, int, int]] = []
        self.held: list[np.ndarray] = []
        self.count = 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.offset += len(data)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc is not None, doc or 0, len(ids)))
        self.total += len(ids)
        self.held.append(ids.astype(np.uint32))
        self.count += len(ids)
        if self.count >= GROUP * rangecoder.BLOCK:
            self._flush(False)

    def _put_table(self, mark: bytes, table: bytes) -> None:
        table = zlib.compress(table)
        self._put(_TABLE.pack(mark, len(table), zlib.crc32(table)) + table)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, dtype=np.uint32)
        whole = len(ids) if last else len(ids) // rangecoder.BLOCK * rangecoder.BLOCK
        # a copy: what is left does not hold the memory of all that was written
        self.held, self.count = [ids[whole:].copy()], len(ids) - whole
        step = GROUP * rangecoder.BLOCK
        for first in range(0, whole, step):
            self._put_group(ids[first : min(whole, first + step)])

    def _put_group(self, ids: np.ndarray) -> None:
        part = [ids[i : i + rangecoder.BLOCK] for i in range(0, len(ids), rangecoder.BLOCK)]
        wide = [i for i, block in enumerate(part) if int(block.max()) >> 16]
        high = [(part[i] >> 16).astype(np.uint16) for i in wide]
        low = [block.astype(np.uint16) for block in part]
        shares = [rangecoder.Shares.counted(blocks) for blocks in (low, high) if blocks]
        upper = dict(zip(wide, rangecoder.encode(high, shares[-1])))
        for i, data in enumerate(rangecoder.encode(low, shares[0])):
            mark = b"BLK1"
            if i in upper:
                mark, data = b"BLK2", struct.pack("<I", len(data)) + data + upper[i]
            plain = zlib.crc32(part[i].astype("<u4").tobytes())
            self._put(_HEAD.pack(mark, len(part[i]), len(data), zlib.crc32(data), plain) + data)
        self._put_table(b"SHR1", b"".join(s.sizes.astype("<u4").tobytes() for s in shares))

    def close(self) -> None:
        self._flush(True)
        at = self.offset
        known, docs, sizes = zip(*self.docs) if self.docs else [()] * 3
        table = struct.pack("<Q", len(docs)) + np.array(known, "u1").tobytes()
        self._put_table(b"DOCS", table + np.array(docs, "<i8").tobytes() + np.array(sizes, "<u8").tobytes())
        self._put(_TRAILER.pack(at, MAGIC))


def _read_table(file, at: int, expected: bytes) -> tuple[bytes, int]:
    """The table at this place and where it ends."""
    file.seek(at)
    mark, length, crc = _TABLE.unpack(file.read(_TABLE.size))
    table = file.read(length)
    if mark != expected or zlib.crc32(table) != crc:
        raise ValueError(f"damaged table {expected.decode()} at {at}")
    return zlib.decompress(table), at + _TABLE.size + length


def read_documents(file) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Which document ids are not null, the ids, numbers of token ids, and where the table starts."""
    size = file.size()
    file.seek(size - _TRAILER.size)
    at, magic = _TRAILER.unpack(file.read(_TRAILER.size))
    file.seek(0)
    if magic != MAGIC or file.read(8) != MAGIC:
        raise ValueError("not a file of ids")
    table, _ = _read_table(file, at, b"DOCS")
    (n,) = struct.unpack_from("<Q", table)
    known = np.frombuffer(table, "u1", n, 8).astype(bool)
    return known, np.frombuffer(table, "<i8", n, 8 + n), np.frombuffer(table, "<u8", n, 8 + 9 * n).astype(np.int64), at


def read_blocks(file, end: int) -> Iterator[np.ndarray]:
    """The ids of all blocks, a group of blocks at a time, in order."""
    at = len(MAGIC)
    while at < end:
        sizes, payloads, sums, wide, upper = [], [], [], [], []
        while True:
            file.seek(at)
            head = file.read(_HEAD.size)
            if head[:4] == b"SHR1" or at >= end:
                break
            mark, n, length, crc, plain = _HEAD.unpack(head)
            data = file.read(length)
            if mark not in (b"BLK1", b"BLK2") or zlib.crc32(data) != crc:
                raise ValueError(f"damaged block at {at}")
            if mark == b"BLK2":
                low = 4 + struct.unpack_from("<I", data)[0]
                wide.append(len(sizes))
                upper.append(data[low:])
                data = data[4:low]
            sizes.append(n)
            payloads.append(data)
            sums.append(plain)
            at += _HEAD.size + length
        table, at = _read_table(file, at, b"SHR1")
        table = np.frombuffer(table, "<u4").reshape(-1, 1 << 16)
        shares = [rangecoder.Shares(line) for line in table]
        blocks = rangecoder.decode(payloads, sizes, shares[0])
        for i, high in zip(wide, rangecoder.decode(upper, [sizes[i] for i in wide], shares[-1])):
            blocks[i] = blocks[i] | high.astype(np.uint32) << np.uint32(16)
        for block, plain in zip(blocks, sums):
            if zlib.crc32(block.astype("<u4").tobytes()) != plain:
                raise ValueError(f"wrong ids in a block before {at}")
        yield np.concatenate(blocks)


def documents(file) -> Iterator[tuple[int | None, int, int, int]]:
    """Per document its id, first id's place in the file, number of ids and their CRC-32."""
    known, docs, sizes, end = read_documents(file)
    held, start = np.empty(0, dtype=np.uint32), 0
    groups = read_blocks(file, end)
    crc, left, i = 0, int(sizes[0]) if len(sizes) else 0, 0
    while i < len(sizes):
        while not len(held) and left:
            held = next(groups)
        part = held[:left]
        crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
        held, left = held[len(part) :], left - len(part)
        if not left:
            yield (int(docs[i]) if known[i] else None), start, int(sizes[i]), crc
            start += int(sizes[i])
            i += 1
            crc, left = 0, int(sizes[i]) if i < len(sizes) else 0


def write_ids(docs: DataFrame, path: str, kind: str, id_col="doc_id", text_col="text", end_id=0) -> tuple[DataFrame, str]:
    """Encode, order and write; a table of the files (``path, base, n_docs, n_ids``) and their folder.

    ``base`` counts the ids of all files before.
    """
    folder = new_folder(docs.sparkSession, "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path, kind)
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        name = f"{uuid4().hex}.ids"
        end = struct.pack("<I", end_id)
        out = None
        for batch in batches:
            texts = (t.as_py() for t in batch.column("body"))
            for doc, ids in zip(batch.column("id").to_pylist(), coder.encode(texts)):
                if out is None:
                    stream = files.open_output_stream(f"{base}/{name}", compression=None)
                    out = Writer(stream)
                out.add(doc, np.frombuffer(ids + end, dtype="<u4"))
        if out is None:
            return
        out.close()
        stream.close()
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "path": [name],
            "n_docs": pa.array([len(out.docs)], pa.int64()), "n_ids": pa.array([out.total], pa.int64()),
        })

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    order = [F.asc_nulls_first("id"), F.xxhash64("body")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    listed = keep(placed.mapInArrow(write, "part int, path string, n_docs bigint, n_ids bigint"), "id-list")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return listed.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"), "n_docs", "n_ids"), folder


def read_ids(listed: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                with files.open_input_file(f"{base}/{path}") as file:
                    rows = []
                    for doc, start, size, crc in documents(file):
                        rows.append((doc, before + start, size, crc))
                        if len(rows) == 10_000:
                            yield _batch(rows)
                            rows = []
                    yield _batch(rows)

    spread = listed.repartition(max(1, min(listed.count(), 10_000)), "path")
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * 4
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})
