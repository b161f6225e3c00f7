"""WARC archives: one gzip member per record, read back record by record.

Archives are written by the tasks that hold the pages, to a folder that all
executors share.  A task names its files by its own random number, so a task that
runs twice leaves a file that nobody lists: the table of archives holds only what
finished tasks have reported.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.session import materialize, session_folder

VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An archive is closed after this many bytes and the next one begun.
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 16


class DamagedArchive(ValueError):
    """A record that is cut short, wrongly framed or fails its digest."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, record_id: str, url: str, date: str, payload: bytes, more: dict[str, str]) -> bytes:
    """One record as a gzip member.  A revisit has no block; the digest is of the full payload."""
    block = b"" if kind == "revisit" else payload
    headers = {
        "WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": date, "WARC-Target-URI": _one_line(url),
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}", "WARC-Block-Digest": f"sha1:{digest_of(block)}",
        "Content-Type": "text/html;charset=utf-8", **more, "Content-Length": str(len(block)),
    }
    head = b"\r\n".join([VERSION, *(f"{k}: {v}".encode() for k, v in headers.items()), b"", b""])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def _one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, in order.

    Members are inflated as their bytes arrive, so one record is held at a time.
    Framing is by Content-Length; the block digest is verified, and for records
    with a full block the payload digest too.  DamagedArchive if something is off.
    """
    raw = b""
    while True:
        raw = raw or stream.read(READ_BYTES)
        if not raw:
            return
        member, plain = zlib.decompressobj(31), bytearray()
        try:
            while not member.eof:
                plain += member.decompress(raw)
                raw = member.unused_data
                if not member.eof:
                    raw = stream.read(READ_BYTES)
                    if not raw:
                        raise DamagedArchive("the archive ends within a record")
        except zlib.error as error:
            raise DamagedArchive(str(error)) from error
        yield _parsed(bytes(plain))


def _parsed(plain: bytes) -> tuple[dict[str, str], bytes]:
    head, blank, rest = plain.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if first != VERSION or not blank:
        raise DamagedArchive("a record does not begin with a WARC header")
    headers = dict(line.decode().split(": ", 1) for line in lines)
    length = int(headers["Content-Length"])
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise DamagedArchive("a record's length is not its Content-Length")
    if headers["WARC-Block-Digest"] != f"sha1:{digest_of(block)}":
        raise DamagedArchive("a record's block fails its digest")
    if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != f"sha1:{digest_of(block)}":
        raise DamagedArchive("a record's payload fails its digest")
    return headers, block


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write (page_id, url, html) to archives under ``folder``; the table of them: archive, n_records.

    Payload is the html in UTF-8, null being empty.  Of pages with equal payloads
    of at least ``least_bytes`` the one with the largest page_id is a response and
    the others revisit it; so are rows that repeat that page_id.  A page without
    page_id is larger than none: it is a response only where no other page has the
    payload.  Archives are written when the table is made; it is made once and kept.
    """
    spark = pages.sparkSession
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    keyed = rows.withColumn("sha", F.sha1("html")).withColumn("size", F.octet_length("html"))
    newest = keyed.filter(F.col("size") >= least_bytes).groupBy("sha").agg(F.max("page_id").alias("newest"))
    marked = (
        keyed.select("page_id", "sha").distinct().join(newest, "sha")
        .filter("NOT page_id <=> newest").select(F.col("page_id").alias("id"), F.col("sha").alias("digest"), "newest")
    )
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("digest"))
    ready = keyed.join(marked, same, "left").select("page_id", "url", "html", "newest")
    filesystem, root = fs.FileSystem.from_uri(_uri(folder))
    filesystem.create_dir(root, recursive=True)
    target = _uri(folder)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = fs.FileSystem.from_uri(target)
        run, number, out, count = uuid.uuid4().hex, 0, None, 0
        for batch in batches:
            for page_id, url, html, newest in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"{run}-{number:05d}.warc.gz"
                    out = files.open_output_stream(f"{place}/{name}", compression=None)
                payload = html.encode()
                more = {"X-Payload-Length": str(len(payload))}
                if newest is not None:
                    more |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<urn:page:{newest}>"}
                kind = "response" if newest is None else "revisit"
                out.write(record(kind, f"<urn:page:{'' if page_id is None else page_id}>", url, date, payload, more))
                count += 1
                if out.tell() >= ARCHIVE_BYTES:
                    out.close()
                    yield _listed(name, count)
                    out, count, number = None, 0, number + 1
        if out is not None:
            out.close()
            yield _listed(name, count)

    return materialize(ready.mapInArrow(work, "archive string, n_records long"), "archives")


def _listed(name: str, count: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], names=["archive", "n_records"])


def _uri(folder: str) -> str:
    return f"file://{folder}" if folder.startswith("/") else folder


READ_SCHEMA = (
    "archive string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def read_warc(archives: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """One row per record of the listed archives, each read from its start by one task.

    A revisit has no payload; its length and digest are those of the payload it
    refers to.  No archives give no rows.
    """
    target = _uri(folder)
    schema = READ_SCHEMA if payload else READ_SCHEMA.rsplit(",", 1)[0]
    arrow = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [part.split()[0] for part in schema.split(", ")]

    def page(value: str | None) -> int | None:
        digits = value[len("<urn:page:") : -1] if value else ""
        return int(digits) if digits else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = fs.FileSystem.from_uri(target)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{place}/{name}", compression=None) as stream:
                    for head, block in records(stream):
                        full = int(head["X-Payload-Length"])
                        rows.append((
                            name, page(head["WARC-Record-ID"]), head["WARC-Target-URI"], full,
                            head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"],
                            page(head.get("WARC-Refers-To")), block,
                        ))
                        held += len(block) if payload else 200
                        if held >= 4 << 20:
                            yield _batch(rows, names, arrow)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, names, arrow)

    count = max(archives.count(), 1)
    return archives.select("archive").repartition(count, "archive").mapInArrow(work, schema)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows))[: len(names)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def new_folder(spark: SparkSession) -> str:
    """A folder for archives that no other call uses."""
    return f"{session_folder(spark)}/warc-{uuid.uuid4().hex}"
