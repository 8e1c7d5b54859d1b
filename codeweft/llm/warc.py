"""WARC archives: a writer, and a reader that salvages damaged ones.

Every record is a gzip member of its own. Spark's own text writer puts members into
files on any file system it knows, with the separator that is the last byte of a
member: the top byte of the length, which is zero below 16 MiB. Behind a larger
member that zero byte is padding, which gzip readers skip.

The reader checks each member's CRC, the record's lengths and its digests. Where a
check fails it looks for the next gzip member or version line from which a whole
record can be read, goes on there, and logs the bytes in between as a gap. The same
goes for the records inside one member; of a damaged or cut-off member the records in
the part that unpacks are kept, behind damage only those with a digest. A file is read
as a whole, so a task ends one behind the member that brings it to ``FILE_BYTES``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeweft.llm.common import keep, table
from codeweft.session import scratch

FILE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6
_FEW = 10_000
_STEP = 1 << 15
_MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    got = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(got[1]) if got else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record; a revisit keeps the HTTP headers and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _name(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha1:{sha1_32(payload)}",
        "WARC-Block-Digest": f"sha1:{sha1_32(block)}",
        "WARC-Profile": _REVISIT if revisit else None,
        "WARC-Refers-To": _name(refers_to) if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


_MEMBER = pa.schema([("archive", pa.int32()), ("member", pa.binary())])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members, numbered by the archive of the task that they go to."""
    archive, size = 0, 0
    for batch in batches:
        numbers, out = [], []
        for row in batch.to_pylist():
            payload = (row["html"] or "").encode()
            got = member(record(row["page_id"], row["url"], payload, row["first"], row["revisit"]))
            out.append(got[:-1] if got[-1] == 0 else got)  # the separator is that byte
            numbers.append(archive)
            size += len(got)
            if size >= FILE_BYTES:
                archive, size = archive + 1, 0
        yield table(_MEMBER, archive=numbers, member=out)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html).

    Of rows with equal payloads of at least ``least_bytes`` bytes those with the
    largest id are responses and the others revisit them; null ids come last. Only
    payloads that occur twice are joined, and no payload is shuffled unless there are
    many of those. Files lie in a folder for each number that a task gives its archives.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.encode("html", "utf-8")))
    sized = rows.where(F.octet_length("html") >= least_bytes)
    again = sized.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("times"))
    again = again.where("times > 1").select("digest", "first", F.lit(True).alias("again"))
    if len(again.select(F.lit(1)).take(_FEW + 1)) <= _FEW:
        again = F.broadcast(again)
    out = rows.join(again, "digest", "left")
    revisit = F.coalesce(F.col("again"), F.lit(False)) & (F.octet_length("html") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    out = out.select("page_id", "url", "html", "first", revisit.alias("revisit"))
    lines = out.mapInArrow(_members, "archive int, member binary").select("archive", F.col("member").cast("string").alias("value"))
    lines.write.partitionBy("archive").option("lineSep", "\x00").text(path)


@dataclass(frozen=True)
class Found:
    """A record, or a gap if ``fields`` is None."""

    begin: int
    end: int
    fields: dict[str, str] | None
    block: bytes
    reason: str = ""


def _parse(data: bytes, begin: int) -> tuple[dict[str, str], bytes, int]:
    """The record whose version line is at ``begin``; ValueError if it fails a check."""
    version = _VERSION.match(data, begin)
    if not version:
        raise ValueError("no version line")
    stop = data.find(b"\r\n\r\n", version.end())
    if stop < 0:
        raise ValueError("header not ended")
    fields: dict[str, str] = {}
    for line in data[version.end() : stop].split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header line without colon")
        fields[key.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not fields.get("content-length", "").isdecimal():
        raise ValueError("no content length")
    end = stop + 4 + int(fields["content-length"])
    block = data[stop + 4 : end]
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("record not ended")
    for field, part in (("warc-block-digest", block), ("warc-payload-digest", payload_of(fields, block))):
        digest = fields.get(field, "")
        if part is not None and digest.startswith("sha1:") and digest[5:] != sha1_32(part):
            raise ValueError(f"{field} differs")
    return fields, block, end + 4


def payload_of(fields: dict[str, str], block: bytes) -> bytes | None:
    """The payload that a record carries, None if it carries none."""
    if fields.get("warc-type") == "revisit":
        return None
    if fields.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _unpacked(data: bytes, begin: int) -> tuple[bytes, int, str, list[tuple[int, int]]]:
    """What the gzip member at ``begin`` holds as far as it can be unpacked, where
    reading it stopped, what is wrong with it, and how far it was unpacked at which
    places of ``data``."""
    unpacker = zlib.decompressobj(31)
    parts, read, size, steps, wrong = [], begin, 0, [(0, begin)], ""
    step = _STEP
    while read < len(data) and not unpacker.eof:
        try:
            parts.append(unpacker.decompress(data[read : read + step]))
        except zlib.error:
            if step == 1:
                wrong = "member damaged"
                break
            # Again up to here, then byte by byte to the damaged one.
            unpacker, step = zlib.decompressobj(31), 1
            unpacker.decompress(data[begin:read])
            continue
        size += len(parts[-1])
        read = min(read + step, len(data))
        steps.append((size, read))
    if not wrong and not unpacker.eof:
        wrong = "member not ended"
    return b"".join(parts), read - len(unpacker.unused_data), wrong, steps


@dataclass(frozen=True)
class _Part:
    """A record of a member, or a gap if ``fields`` is None, by place when unpacked."""

    begin: int
    end: int
    fields: dict[str, str] | None
    block: bytes
    reason: str = ""


def _parts(whole: bytes, digests: bool) -> Iterator[_Part]:
    """The records in unpacked data, and the gaps between them. With ``digests``,
    only records that carry one count."""
    at, gap, reason = 0, None, ""
    while at < len(whole):
        try:
            fields, block, end = _parse(whole, at)
            if digests and not any(fields.get(k, "").startswith("sha1:") for k in _proofs(fields)):
                raise ValueError("no digest in a damaged member")
        except ValueError as error:
            if gap is None:
                gap, reason = at, str(error)
            following = _VERSION.search(whole, at + 1)
            at = following.start() if following else len(whole)
            continue
        if gap is not None:
            yield _Part(gap, at, None, b"", reason)
            gap = None
        yield _Part(at, end, fields, block)
        at = end
    if gap is not None:
        yield _Part(gap, len(whole), None, b"", reason)


def _proofs(fields: dict[str, str]) -> tuple[str, ...]:
    """The digests that cover what a record carries."""
    return ("warc-block-digest",) if fields.get("warc-type") == "revisit" else ("warc-block-digest", "warc-payload-digest")


def _one(data: bytes, begin: int) -> tuple[list[Found], int, str]:
    """The records of the member or the plain record at ``begin`` with the gaps
    between them, where to go on, and why the bytes from there on can't be read, if
    so. ValueError if there is no record."""
    if not data.startswith(_MAGIC, begin):
        fields, block, end = _parse(data, begin)
        return [Found(begin, end, fields, block)], end, ""
    whole, end, wrong, steps = _unpacked(data, begin)
    parts = list(_parts(whole, wrong == "member damaged"))
    last = max((p.end for p in parts if p.fields is not None), default=None)
    if last is None or (wrong == "member damaged" and len(parts) == 1):  # then its header may be what is damaged
        raise ValueError(wrong or next((p.reason for p in parts), "member without record"))
    if wrong:  # what follows the last whole record is part of the gap from there on
        parts = [p for p in parts if p.end <= last]
    out = [
        Found(begin, end, p.fields, p.block, f"{p.reason}, unpacked bytes {p.begin} to {p.end}" if p.fields is None else "")
        for p in parts
    ]
    if wrong:
        end = max(read for size, read in steps if size < last)
        wrong = f"{wrong}, unpacked bytes from {last}"
    return out, end, wrong


def salvage(data: bytes) -> Iterator[Found]:
    """All records of an archive that can be read, and the gaps between them.

    A gap inside a member has the member's place, and its reason says which unpacked
    bytes it is. Behind the last whole record of a damaged or cut-off member the gap
    begins at the last place up to which that record was not yet unpacked. Digests
    don't cover a record's own header, so a damaged member with nothing but one record
    is a gap."""
    at, gap, reason = 0, None, ""
    while at < len(data):
        if data[at] == 0 and gap is None:
            at += 1  # padding
            continue
        try:
            found, end, wrong = _one(data, at)
        except ValueError as error:
            if gap is None:
                gap, reason = at, str(error)
            following = _START.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield Found(gap, at, None, b"", reason)
            gap = None
        yield from found
        if wrong:
            gap, reason = end, wrong
            following = _START.search(data, max(end, at + 1))
            at = following.start() if following else len(data)
        else:
            at = end
    if gap is not None:
        yield Found(gap, len(data), None, b"", reason)


_READ = pa.schema(
    [
        ("file", pa.string()),
        ("begin", pa.int64()),
        ("end", pa.int64()),
        ("reason", pa.string()),
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
_READ_DDL = (
    "file string, begin bigint, end bigint, reason string, page_id bigint, payload_bytes bigint, "
    "payload_digest string, record_type string, refers_to bigint, payload binary"
)
_LENGTH = re.compile(rb"(?i)\r\nContent-Length:\s*(\d+)")


def _row(file: str, found: Found, with_payload: bool) -> dict:
    row = dict.fromkeys(_READ.names) | {"file": file, "begin": found.begin, "end": found.end}
    if found.fields is None:
        return row | {"reason": found.reason}
    payload = payload_of(found.fields, found.block)
    if payload is None:
        length = _LENGTH.search(found.block)
        size = int(length[1]) if length else None
    else:
        size = len(payload)
    return row | {
        "page_id": _page(found.fields.get("warc-record-id")),
        "payload_bytes": size,
        "payload_digest": found.fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "record_type": found.fields.get("warc-type"),
        "refers_to": _page(found.fields.get("warc-refers-to")),
        "payload": payload if with_payload else None,
    }


def _salvaged(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                rows: list[dict] = []
                for found in salvage(content.as_py()):
                    rows.append(_row(file, found, with_payload))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _READ)

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row for every record, and one with a ``reason`` for every gap of bytes that
    could not be read. No files: no rows."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInArrow(_salvaged(with_payload), _READ_DDL)


def quarantine(found: DataFrame, path: str) -> int:
    """Log the gaps among what :func:`read_archives` found as Parquet files in ``path``
    (file, begin, end, bytes, reason), also where there are none. How many there are."""
    gaps = found.where("reason IS NOT NULL")
    gaps.select("file", "begin", "end", (F.col("end") - F.col("begin")).alias("bytes"), "reason").write.parquet(path)
    return found.sparkSession.read.parquet(path).count()


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``, as read
    back from archives of ``pages``.

    Null and empty html is an empty payload. Rows that repeat the largest id of a
    payload are all responses. A null id is read back as null. Other columns than
    page_id, url and html are not archived. What the reader could not read is logged
    in a table beside the archives, and warned about.
    """
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(pages, path, least_bytes)
    found = keep(read_archives(spark, path), "warc_records")
    gaps = scratch(spark, "warc_gaps")
    if lost := quarantine(found, gaps):
        warnings.warn(f"{lost} gaps in the archives under {path}, logged in {gaps}", stacklevel=2)
    return found.where("reason IS NULL").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
