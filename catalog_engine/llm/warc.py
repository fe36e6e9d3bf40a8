"""WARC archives: a writer with revisit records, and a salvage reader.

Writer: one record per page. Of the pages with equal payloads the one with the
largest page_id is written in full, the others as revisit records that name it.
Records are gzip members of their own, written by Spark's text sink: a value is
a row of members, and the line separator is an empty member, so a file is a
plain row of members. A file ends at `records_per_file` or `bytes_per_file`,
which it passes by one record at most for each of its values.

Reader: an archive is read record by record. A record is a gzip member or a
plain record that begins with a version line; it counts if its gzip check sum,
its header, its length, its trailer and its digests hold. Where a check fails,
the reader looks for the next position at which a whole valid record begins,
goes on from there, and logs the bytes between as a gap with the reason. The
same search runs over the plain bytes of a gzip member, also of as many as can
be unpacked of a broken or cut-off one: its valid records count, and the bytes
between are inner gaps. In a member whose check sum fails a record counts only
if a block digest proves it; in one that is cut off the other checks suffice.

One task holds one archive; those of the writer are bounded by bytes, others may
have the 2 GB that Spark allows a value, and Spark fails beyond. Each version
line is read up to its first bad header line, so the search is linear unless
headers are made to overlap on purpose.

Defined cases: a null html is an empty payload; a null url is left out; pages
with a null page_id come before all others, so they revisit a page with an id
if there is one; rows with the same page_id and payload as the response are
responses too. Line breaks in a url are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks

RECORDS_PER_FILE = 10_000
BYTES_PER_FILE = 128 << 20
#: Values that a file is made of, so that none is large.
PIECES = 32
#: Bytes given to the decompressor at a time.
STEP = 1 << 13
DATE = "2024-01-01T00:00:00Z"
VERSION = b"WARC/1.1\r\n"
URN = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("path string, start long, end long, problem string, inner_start long, inner_end long, record_type string, page_id long, url string, "
          "payload_bytes long, payload_digest string, refers_to long, payload binary")
_RECORD = pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("problem", pa.string()),
                     ("inner_start", pa.int64()), ("inner_end", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                     ("payload", pa.binary())])
_NUMBER = re.compile(rb"[0-9]+\Z")


class Damaged(Exception):
    """What is wrong with the bytes at a position."""


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


class Stretch(NamedTuple):
    """A range of an archive. With records it is valid but for its `gaps` (from,
    to, problem), which count plain bytes of the member that it is; without
    records and with a problem it is a gap itself. A member whose end is lost
    has both records and a problem, and reaches up to the next valid start."""
    start: int
    end: int | None
    problem: str | None
    records: list[Record]
    gaps: list[tuple[int, int | None, str]]
    #: Where to look for the next record if the end is not known.
    behind: int | None = None


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member without time or name."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


EMPTY_MEMBER = member(b"")


def _urn(page_id: int | None) -> str:
    return f"<{URN}{'none' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    text = (urn or "")[1 + len(URN):-1]
    return int(text) if text.lstrip("-").isdigit() else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A plain response or revisit record; a revisit keeps the HTTP header only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    head += [("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)), ("WARC-Block-Digest", "sha1:" + base32_sha1(block)),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int, proven: bool = False) -> tuple[Record, int]:
    """The plain record at a position and its end; Damaged if a check fails, or
    if a block digest must prove it and there is none."""
    if data[at:at + 5] != b"WARC/" or data[at + 8:at + 10] != b"\r\n":
        raise Damaged("no version line")
    headers, lo = {}, at + 10
    while True:
        stop = data.find(b"\r\n", lo)
        if stop < 0:
            raise Damaged("header has no end")
        line, lo = data[lo:stop], stop + 2
        if not line:
            break
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without colon")
        try:
            field, text = name.decode("ascii").strip().lower(), value.decode().strip()
        except UnicodeDecodeError:
            raise Damaged("header is not UTF-8") from None
        if field in headers and field != "warc-concurrent-to":
            raise Damaged("header repeats a field")
        headers[field] = text
    if not {"warc-type", "warc-record-id", "content-length"} <= headers.keys():
        raise Damaged("header lacks a field")
    if not _NUMBER.match(headers["content-length"].encode()):
        raise Damaged("length is no number")
    hi = lo + int(headers["content-length"])
    if hi > len(data):
        raise Damaged("block is cut off")
    if data[hi:hi + 4] != b"\r\n\r\n":
        raise Damaged("no record end after the block")
    block, digest = data[lo:hi], headers.get("warc-block-digest", "")
    if proven and not digest.startswith("sha1:"):
        raise Damaged("no digest proves the record")
    if digest.startswith("sha1:") and digest[5:] != base32_sha1(block):
        raise Damaged("block digest differs")
    if headers["warc-type"] == "response" and headers.get("warc-payload-digest", "").startswith("sha1:"):
        if headers["warc-payload-digest"][5:] != base32_sha1(block.partition(b"\r\n\r\n")[2]):
            raise Damaged("payload digest differs")
    return Record(headers, block), hi + 4


def _plain_at(data: bytes, at: int, proven: bool = False) -> Stretch:
    found, end = parse_record(data, at, proven)
    return Stretch(at, end, None, [found], [])


def _unpack(data: bytes, at: int) -> tuple[bytes, int | None, str | None]:
    """What can be unpacked of the member at a position, where it ends, and what
    is wrong with it. Bytes are fed in steps (what is left over is copied), and
    one by one in the step that fails, so that all before the fault is kept."""
    calm = len(data)
    while True:
        unpack, pieces, fed = zlib.decompressobj(31), [], at
        try:
            while not unpack.eof and fed < len(data):
                step = STEP if fed < calm else 1
                pieces.append(unpack.decompress(data[fed:fed + step]))
                fed += step
        except zlib.error:
            if step == 1:
                return b"".join(pieces), None, "gzip member is broken"
            calm = fed
            continue
        if not unpack.eof:
            return b"".join(pieces), None, "gzip member is cut off"
        return b"".join(pieces), min(fed, len(data)) - len(unpack.unused_data), None


def _bytes_for(data: bytes, at: int, size: int) -> int:
    """The position up to which a member must be fed to give `size` plain bytes."""
    unpack, fed, given = zlib.decompressobj(31), at, 0
    while given < size:
        before = unpack.copy()
        try:
            more = len(unpack.decompress(data[fed:fed + STEP]))
        except zlib.error:
            more = size
        if given + more < size:
            given, fed = given + more, fed + STEP
            continue
        unpack = before  # it is in this step
        while given < size:
            given += len(unpack.decompress(data[fed:fed + 1]))
            fed += 1
    return fed


_VERSION = re.compile(rb"WARC/\d\.\d\r\n")
_START = re.compile(rb"\x1f\x8b\x08|" + _VERSION.pattern)


def _at(data: bytes, at: int) -> Stretch:
    """The record or member that begins at a position; Damaged if it has no
    valid record."""
    if data[at:at + 3] != b"\x1f\x8b\x08":
        return _plain_at(data, at)
    plain, end, problem = _unpack(data, at)
    proven = problem == "gzip member is broken"
    inner = list(stretches(plain, _VERSION, lambda d, k: _plain_at(d, k, proven)))
    records = [r for s in inner for r in s.records]
    if not records and (plain or problem):
        raise Damaged(problem or inner[0].problem)
    lost = [(s.start, s.end, s.problem) for s in inner if s.problem]
    if not problem:
        return Stretch(at, end, None, records, lost)
    behind = _bytes_for(data, at, max(s.end for s in inner if s.records))
    return Stretch(at, None, problem, records, [*lost, (len(plain), None, problem)], behind)


def stretches(data: bytes, starts: re.Pattern = _START,
              read: Callable[[bytes, int], Stretch] = _at) -> Iterator[Stretch]:
    """The whole of the data as stretches, one beginning where the last ends."""
    def after(position: int) -> int | None:
        start = starts.search(data, position)
        return start.start() if start else None

    at, broken = 0, None
    while broken or at < len(data):
        look, found, problem = after(broken.behind) if broken else at, None, None
        while look is not None and found is None:
            try:
                found = read(data, look)
            except Damaged as e:
                problem = problem or str(e)
                look = after(look + 1)
        stop = found.start if found else len(data)
        if broken:
            yield broken._replace(end=stop)
        elif stop > at:
            yield Stretch(at, stop, problem, [], [])
        broken = None
        if found is None:
            return
        if found.end is None:
            broken = found
        else:
            yield found
            at = found.end


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, list[Record]]]:
    """(start, end, problem, records) of the stretches of an archive."""
    return ((s.start, s.end, s.problem, s.records) for s in stretches(data))


def _row(path: str, start: int, end: int, r: Record) -> tuple:
    h = r.headers
    http, _, payload = r.block.partition(b"\r\n\r\n")
    kind = h["warc-type"]
    if kind == "revisit":
        size = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        n_bytes = int(size[1]) if size else None
    else:
        n_bytes = len(payload)
    return (path, start, end, None, None, None, kind, _page(h["warc-record-id"]), h.get("warc-target-uri"), n_bytes,
            h.get("warc-payload-digest", "")[5:] or None, _page(h.get("warc-refers-to")),
            payload if kind == "response" else None)


def with_originals(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to, revisit: equal payloads of at least
    `least_bytes` refer to the largest page_id that has them. The join is on a
    digest that may be very common; it is an ordinary join whose large
    partitions Spark splits."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    base = base.withColumn("payload_key", F.sha2("html", 256))
    tops = base.groupBy("payload_key").agg(F.max("page_id").alias("top"))
    revisit = (F.octet_length("html") >= least_bytes) & F.col("top").isNotNull() & ~F.col("top").eqNullSafe(F.col("page_id"))
    return base.join(tops, "payload_key").select(
        "page_id", "url", F.col("html").alias("text"), revisit.alias("revisit"),
        F.when(revisit, F.col("top")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE,
                   bytes_per_file: int = BYTES_PER_FILE) -> None:
    """Writes the pages (page_id, url, html) as archives into a new folder."""
    pieces = min(PIECES, records_per_file)
    most_rows, most_bytes = records_per_file // pieces, bytes_per_file // pieces

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for cols in chunks(batches):
            for i, url, text, to, again in zip(cols["page_id"], cols["url"], cols["text"], cols["refers_to"], cols["revisit"]):
                held.append(member(record(i, url, text.encode(), to, again)))
                size += len(held[-1])
                if len(held) >= most_rows or size >= most_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

    (with_originals(pages, least_bytes).mapInArrow(members, "value binary")
     .select(F.col("value").cast("string").alias("value"))  # the bytes as they are
     .write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
     .option("maxRecordsPerFile", pieces).text(path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record, and a row per gap (with `problem`): a range of the
    archive, or in the member at that range the plain bytes from `inner_start`
    to `inner_end` (null: all that could not be unpacked)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                found, held = [], 0
                for s in stretches(content.as_py()):
                    lost = s.gaps or ([(None, None, s.problem)] if s.problem else [])
                    found += [(name.as_py(), s.start, s.end, what, lo, hi) + (None,) * 7 for lo, hi, what in lost]
                    found += [_row(name.as_py(), s.start, s.end, r) for r in s.records]
                    held += sum(len(r.block) for r in s.records)
                    if held > 8 << 20:
                        yield _batch(found)
                        found, held = [], 0
                if found:
                    yield _batch(found)

    return (spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(rows, RECORD))


def _batch(found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _RECORD)], schema=_RECORD)


def gaps(records: DataFrame) -> DataFrame:
    """The quarantined byte ranges, those inside members with their inner range."""
    return records.filter("problem is not null").select("path", "start", "end", "problem", "inner_start", "inner_end")
