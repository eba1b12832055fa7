"""WARC archives of pages, and a normaliser for archives that are one gzip stream.

* ``write_archives`` writes one WARC record per page. Of records with equal payloads the one with
  the largest page id is a ``response``; the others are ``revisit`` records without a payload.
  Each archive is a single gzip stream over all its records, which no reader can enter midway.
* ``normalise`` inflates such an archive once, front to back, holding one record at a time. It
  writes every record as a gzip member of its own to a second archive, and next to it a sidecar
  index with a line per record: offset, length, record id and type.
* ``read_records`` seeks to each offset of the index, inflates that member alone, and checks a
  response's payload against its digest.

Tasks write under names of their own and report them in a table; files of a task that was lost
and run again are in no table, so nothing is read twice.

Defined results: a null payload is empty; a null page id appears as null and is smaller than any
other; of rows with equal id and payload all are responses or all refer to that id. Equal means
equal SHA-1 and MD5. Other columns of the pages are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from uuid import uuid4

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import keep, new_folder, open_folder

LEVEL = 5
#: an archive is closed beyond so many payload bytes
ARCHIVE_BYTES = 256 << 20
_STEP = 1 << 20
_END = b"\r\n\r\n"


def record_id(page: int | None) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def page_of(name: str | None) -> int | None:
    text = (name or "null").strip("<>").rpartition(":")[2]
    return None if text == "null" else int(text)


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers: str | None) -> bytes:
    """One WARC record. A revisit keeps digest and length of the payload it leaves out."""
    fields = {
        "WARC-Type": "response" if refers is None else "revisit",
        "WARC-Record-ID": record_id(page),
        "WARC-Target-URI": " ".join((url or "").split()),
        "WARC-Payload-Digest": "sha1:" + digest,
        "X-Payload-Length": str(len(payload)),
    }
    if refers is not None:
        fields |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": refers,
        }
        payload = b""
    fields["Content-Length"] = str(len(payload))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return head.encode() + b"\r\n" + payload + _END


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def split_records(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and whole bytes of each record of a plain WARC stream that arrives in parts."""
    held = bytearray()
    for part in parts:
        held += part
        start = 0
        while (head := held.find(_END, start)) >= 0:
            fields = fields_of(bytes(held[start:head]))
            end = head + 4 + int(fields["Content-Length"]) + 4
            if end > len(held):
                break
            yield fields, bytes(held[start:end])
            start = end
        del held[:start]
    if held:
        raise ValueError("archive ends within a record")


def inflated(stream) -> Iterator[bytes]:
    """Contents of a gzip file of one or more members, in steps of bounded size."""
    pressed = zlib.decompressobj(31)
    while part := stream.read(_STEP):
        while part:
            yield pressed.decompress(part, 4 * _STEP)
            part = pressed.unconsumed_tail
            if pressed.eof:
                part, pressed = pressed.unused_data, zlib.decompressobj(31)
    yield pressed.flush()


def write_archives(pages: DataFrame, id_col="page_id", url_col="url", payload_col="html") -> tuple[DataFrame, str]:
    """A table of the archives (``path``) and the folder in which they are."""
    body = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.unhex(F.sha1("payload")), "md5": F.unhex(F.md5("payload"))})
    prints = rows.select("page", "digest", "md5")
    # a struct has a place for a null id as well
    last = prints.groupBy("digest", "md5").agg(F.max(F.struct("page")).alias("last"), F.count(F.lit(1)).alias("n"))
    revisits = (
        prints.join(last.where("n > 1"), ["digest", "md5"])
        .where(~F.col("page").eqNullSafe(F.col("last.page")))
        .select(
            F.col("page").alias("again"), F.col("digest").alias("d"), F.col("md5").alias("m"),
            F.col("last.page").alias("first"), F.lit(True).alias("revisit"),
        )
        .distinct()
    )
    same = F.col("page").eqNullSafe(F.col("again")) & (F.col("digest") == F.col("d")) & (F.col("md5") == F.col("m"))
    told = rows.join(keep(revisits, "revisits"), same, "left").select(
        "page", "url", "payload", "digest", "first", F.coalesce("revisit", F.lit(False)).alias("revisit")
    )
    folder = new_folder(pages.sparkSession, "archives")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        paths, out, size = [], None, 0
        for batch in batches:
            for page, url, payload, digest, first, again in zip(
                batch["page"], batch["url"], batch["payload"], batch["digest"], batch["first"], batch["revisit"]
            ):
                if out is None:
                    paths.append(f"{base}/{uuid4().hex}.warc.gz")
                    out, press, size = files.open_output_stream(paths[-1], compression=None), zlib.compressobj(LEVEL, wbits=31), 0
                name = base64.b32encode(bytes(digest)).decode()
                refers = record_id(None if first is None else int(first)) if again else None
                one = record(None if page is None else int(page), url, bytes(payload), name, refers)
                out.write(press.compress(one))
                size += len(payload)
                if size > ARCHIVE_BYTES:
                    out.write(press.flush())
                    out.close()
                    out = None
        if out is not None:
            out.write(press.flush())
            out.close()
        yield pd.DataFrame({"path": pd.Series([p.rpartition("/")[2] for p in paths], dtype=str)})

    # ids travel as decimals: pandas has no whole numbers with nulls
    told = told.withColumns({c: F.col(c).cast("decimal(20,0)") for c in ("page", "first")})
    return keep(told.mapInPandas(write, "path string"), "archive-list"), folder


def normalise(archives: DataFrame, folder: str) -> tuple[DataFrame, str]:
    """A table of the rewritten archives with their indexes (``path, index, records``), and their folder."""
    target = new_folder(archives.sparkSession, "members")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = open_folder(folder)
        _, to = open_folder(target)
        files.create_dir(to, recursive=True)
        for batch in batches:
            done = []
            for path in batch["path"]:
                name, offset, records = uuid4().hex, 0, 0
                with (
                    files.open_input_stream(f"{base}/{path}", compression=None) as stream,
                    files.open_output_stream(f"{to}/{name}.warc.gz", compression=None) as out,
                    files.open_output_stream(f"{to}/{name}.idx") as index,
                ):
                    for fields, whole in split_records(inflated(stream)):
                        press = zlib.compressobj(LEVEL, wbits=31)
                        member = press.compress(whole) + press.flush()
                        out.write(member)
                        index.write(f"{offset} {len(member)} {fields['WARC-Type']} {fields['WARC-Record-ID']}\n".encode())
                        offset += len(member)
                        records += 1
                done.append((f"{name}.warc.gz", f"{name}.idx", records))
            yield pd.DataFrame(done, columns=["path", "index", "records"])

    one_each = archives.repartition(max(1, min(archives.count(), 10_000)), "path")
    return keep(one_each.mapInPandas(run, "path string, index string, records bigint"), "member-list"), target


def read_records(archives: DataFrame, folder: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every indexed record."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = open_folder(folder)
        for batch in batches:
            for path, index in zip(batch["path"], batch["index"]):
                with files.open_input_stream(f"{base}/{index}") as lines, files.open_input_file(f"{base}/{path}") as archive:
                    rows = []
                    for line in _lines(lines):
                        rows.append(_read(archive, *line.split(" ")))
                        if len(rows) == 10_000:
                            yield _frame(rows)
                            rows = []
                    yield _frame(rows)

    spread = archives.repartition(max(1, min(archives.count(), 10_000)), "path")
    return spread.mapInPandas(
        run,
        "page_id decimal(20,0), payload_bytes bigint, payload_digest string, record_type string, refers_to decimal(20,0)",
    ).withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def _lines(stream) -> Iterator[str]:
    held = b""
    while part := stream.read(_STEP):
        *whole, held = (held + part).split(b"\n")
        yield from (w.decode() for w in whole)


def _read(archive, offset: str, length: str, kind: str, name: str) -> tuple:
    archive.seek(int(offset))
    (fields, whole), = split_records(iter([zlib.decompress(archive.read(int(length)), 31)]))
    if fields["WARC-Record-ID"] != name or fields["WARC-Type"] != kind:
        raise ValueError(f"the index does not fit the archive at {offset}")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(fields["X-Payload-Length"])
    if kind == "response":
        payload = whole[len(whole) - 4 - int(fields["Content-Length"]) : -4]
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"damaged record {name}")
    refers = page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return page_of(name), size, digest, kind, refers


def _frame(rows: list[tuple]) -> pd.DataFrame:
    from decimal import Decimal

    out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"], dtype=object)
    for c in ("page_id", "refers_to"):
        out[c] = [None if v is None else Decimal(v) for v in out[c]]
    return out.astype({"payload_bytes": "int64", "payload_digest": str, "record_type": str})
