"""WARC archives: written by tasks, read back by byte ranges.

Every record is a gzip member of its own. A reader task gets a byte range of one
archive, looks for the gzip magic number from its start, and takes a place for a
member only when inflating it gives a WARC header. From the first such member on
it goes from member to member. It owns the records that start inside its range
and reads past the end of the range to finish the last one. So a large archive is
read by many tasks, and each record exactly once.

Payloads that occur before are not stored again: of the records with one payload
the one with the largest page id is the response, the others revisit it.

Files are opened through pyarrow's file systems by URI. A task writes under a
name of its own attempt and moves the file when it is whole, so a lost or
repeated task leaves no torn archive. Only files in the manifest are read.

Cases: a null payload is empty. A null page id is written as ``null`` and read as
null; it refers to others and is never the response while there is another id.
Rows that repeat id and payload are both responses. An empty table gives no
archive and no records. Extra columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import run_folder
from .tables import materialize
from .words import slices

MAGIC = b"\x1f\x8b\x08"
LEVEL = 6
#: Archives are closed beyond this size.
ARCHIVE_BYTES = 1 << 30
#: Bytes of a range, and bytes read at once.
RANGE_BYTES = 8 << 20
READ_BYTES = 1 << 20
INFLATE_BYTES = 1 << 14
PAGE = "urn:page:"
HEADER = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a plain path."""
    if re.match(r"[a-z0-9]+:/", uri):
        scheme, _, rest = uri.partition(":")
        return fs.FileSystem.from_uri(uri if rest.startswith("//") else f"{scheme}://{rest}")
    return fs.LocalFileSystem(), uri


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1 digest."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One gzip member with a response, or with a revisit that has no payload."""
    http = HEADER.format(len(payload)).encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{PAGE}{'null' if page_id is None else page_id}>",
        "WARC-Target-URI": re.sub(r"[\x00-\x20]", "", url or "") or f"{PAGE}none",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        fields["WARC-Profile"] = (
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
        fields["WARC-Refers-To"] = f"<{PAGE}{refers_to}>"
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """``page_id, url, html`` with ``refers_to``, null for responses.

    Payloads shorter than ``least`` bytes are all responses. The largest id per
    digest is a grouped maximum; only digests that occur with several ids come
    back, joined to narrow rows.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
    keys = materialize(
        rows.filter(F.octet_length("html") >= least).select("page_id", F.sha1("html").alias("sha1")),
        "payload-digests",
    )
    several = keys.groupBy("sha1").agg(
        F.max("page_id").alias("refers_to"), F.count("*").alias("n")
    ).filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    again = keys.join(several, "sha1").filter("page_id IS NULL OR page_id < refers_to").distinct()
    return (
        rows.withColumn("sha1", F.sha1("html"))
        .join(
            again.select(F.col("page_id").alias("__id"), F.col("sha1").alias("__sha1"), "refers_to"),
            F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("sha1") == F.col("__sha1")),
            "left",
        )
        .drop("sha1", "__id", "__sha1")
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``page_id, url, html, refers_to`` rows; the manifest (path, bytes, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        system.create_dir(base, recursive=True)
        part, number = TaskContext.get().partitionId(), 0
        stream, temporary, size, count = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            stream.close()
            final = f"{base}/part-{part:06d}-{number:04d}.warc.gz"
            system.move(temporary, final)
            path = f"{folder}/part-{part:06d}-{number:04d}.warc.gz"
            return pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [count]})

        for batch in slices(batches, "html"):
            for page_id, url, html, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if stream is None:
                    temporary = f"{base}/.{uuid.uuid4().hex}"
                    stream, size, count = system.open_output_stream(temporary), 0, 0
                data = record(page_id, url, html.encode(), refers, refers is not None)
                stream.write(data)
                size += len(data)
                count += 1
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    stream, number = None, number + 1
        if stream is not None:
            yield closed()

    written = pages.select("page_id", "url", "html", "refers_to").mapInArrow(
        run, "path string, bytes long, records long"
    )
    return materialize(written, "manifest")


class _Source:
    """Bytes of a file from any place, read on as needed."""

    def __init__(self, file, at: int):
        self.file, self.start, self.data = file, at, b""
        file.seek(at)

    def more(self) -> bool:
        data = self.file.read(READ_BYTES)
        self.data += data
        return bool(data)

    def drop(self, until: int) -> None:
        """Forget what is before ``until``, if it is much."""
        if until - self.start >= READ_BYTES:
            self.data = self.data[until - self.start :]
            self.start = until


def _inflate(source: _Source, at: int, most: int | None) -> tuple[bytes, int] | None:
    """A member's bytes and its end; None if there is no whole member at ``at``.

    With ``most``, only about so many bytes of it, enough for the version, and no end.
    """
    least = len(b"WARC/1.")
    unpack, out, used = zlib.decompressobj(31), [], at - source.start
    try:
        while True:
            chunk = source.data[used : used + INFLATE_BYTES]
            if not chunk:
                if source.more():
                    continue
                return None
            used += len(chunk)
            out.append(unpack.decompress(chunk, most or 0))
            if unpack.eof:
                return b"".join(out), source.start + used - len(unpack.unused_data)
            if most and sum(map(len, out)) >= least:
                return b"".join(out), -1
    except zlib.error:
        return None


def records_in(file, begin: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content block of the records that start in ``begin..end``."""
    source, at, sure = _Source(file, begin), begin, False
    while at < end:
        if not sure:
            found = source.data.find(MAGIC, at - source.start)
            if found < 0:
                at = max(at, source.start + len(source.data) - len(MAGIC) + 1)
                source.drop(at)
                if at >= end or not source.more():
                    return
                continue
            at = source.start + found
            if at >= end:
                return
            peek = _inflate(source, at, 16)
            if peek is None or not peek[0].startswith(b"WARC/1."):
                at += 1
                continue
        source.drop(at)
        whole = _inflate(source, at, None)
        if whole is None or not whole[0].startswith(b"WARC/1."):
            at, sure = at + 1, False
            continue
        data, at = whole
        source.drop(at)
        sure = True
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield fields, rest[: int(fields["Content-Length"])]
        if at - source.start >= len(source.data) and not source.more():
            return


def ranges(manifest: DataFrame, size: int = RANGE_BYTES) -> DataFrame:
    """``path, begin, end``: all archives cut into byte ranges."""
    begins = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(size).cast("long"))
    return manifest.select("path", F.explode(begins).alias("begin")).withColumn(
        "end", F.col("begin") + size
    )


def read_archives(manifest: DataFrame, size: int = RANGE_BYTES) -> DataFrame:
    """One row per record: ids, type, lengths, digests and the stored payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, name = opened(path)
                with system.open_input_file(name) as file:
                    rows, held = [], 0
                    for fields, block in records_in(file, begin, end):
                        rows.append(_row(fields, block))
                        held += len(block)
                        if held > READ_BYTES * 4:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    parts = ranges(manifest, size)
    # by number, as Spark would put these few short rows into one task
    whole, number = manifest.agg(F.sum("bytes")).first()[0] or 0, parts.count()
    usual = min(number, manifest.sparkSession.sparkContext.defaultParallelism)
    spread = parts.repartition(max(-(-whole // RANGE_BYTES), usual, 1), "path", "begin")
    return spread.mapInArrow(
        run,
        "page_id long, record_type string, payload_bytes long, payload_digest string, "
        "refers_to long, payload binary",
    )


def _id(value: str | None) -> int | None:
    found = re.fullmatch(rf"<{PAGE}(-?[0-9]+)>", value or "")
    return int(found[1]) if found else None


def _row(fields: dict[str, str], block: bytes) -> tuple:
    kind = fields["WARC-Type"]
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    length, mark = int(fields["WARC-Payload-Length"]), fields["WARC-Payload-Digest"][5:]
    if payload is not None:
        if (len(payload), digest(payload)) != (length, mark):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    ids = _id(fields["WARC-Record-ID"]), _id(fields.get("WARC-Refers-To"))
    return ids[0], kind, length, mark, ids[1], payload


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names
    )


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write all pages into archives of the shared folder and read them back."""
    folder = run_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(with_revisits(pages, least), folder))
