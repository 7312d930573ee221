"""WARC archives: a writer with revisit records and a salvage reader.

The reader checks every gzip member and record (checksum, version line, lengths,
digests). Where a check fails it searches onward for the next member or version
line that opens a valid record, goes on from there, and logs the bytes it passed
over as a gap. One damaged record so costs that record, not the rest of the file.
In a gzip member of many records the search goes on inside its content.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaero.llm.common import materialize, new_folder

SEGMENT_BYTES = 4 << 20
SEGMENTS_PER_FILE = 4
ID_PREFIX = "urn:quaero:page:"
DATE = "2000-01-01T00:00:00Z"

RECORDS = (
    "path string, offset long, length long, kind string, reason string, warc_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)

_CHUNK = 1 << 16
_MAGIC = b"\x1f\x8b\x08"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANDATORY = ("warc-record-id", "warc-date", "warc-type", "content-length")
_VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
_OPENING = re.compile(rb"\x1f\x8b\x08|WARC/\d+\.\d+\r\n")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- writing -------------------------------------------------------------------------


def with_revisits(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """``pages`` plus ``refers_to``: the largest id among equal payloads, null on that record itself.

    Digests are grouped with partial sums before any shuffle. Only digests that
    repeat enter the join, and both its inputs are plain, so a hot digest can be split.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    digest = F.sha1(payload)
    named = pages.where(F.col(id_col).isNotNull() & (F.octet_length(payload) >= min_bytes))
    top = named.groupBy(digest.alias("__digest")).agg(F.max(id_col).alias("__top"), F.count("*").alias("n"))
    top = materialize(top.where("n > 1").drop("n"), "responses")
    refers = F.when((F.octet_length(payload) >= min_bytes) & (F.col("__top") != F.col(id_col)), F.col("__top"))
    joined = pages.withColumn("__digest", digest).join(top, "__digest", "left")
    return joined.withColumn("refers_to", refers).drop("__digest", "__top")


def record_bytes(page_id: object, url: str | None, payload: bytes, refers_to: object = None) -> bytes:
    """One WARC record with its closing blank lines; a revisit has the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    lines += [f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_bytes: int = 0,
) -> None:
    """Writes one record per row below ``folder``, each a gzip member of its own.

    Of equal payloads of at least ``min_bytes`` the largest id is the response and
    the others are revisits; null ids are always responses. A null payload is empty.
    Spark's text writer commits the files, so a lost executor leaves no half file.
    It ends each row with its separator, here one zero byte: a gzip member ends with
    its size, whose last byte is zero below 16 MB, so a segment gives that byte up
    and the writer puts it back. (A segment that ends otherwise gets an empty member.)
    """
    names = [id_col, url_col, "refers_to", payload_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def segment() -> pa.RecordBatch:
            whole = b"".join(held)
            if whole[-1]:
                whole += gzip.compress(b"", mtime=0)
            return pa.RecordBatch.from_arrays([pa.array([whole[:-1]], type=pa.binary())], names=["value"])

        for batch in batches:
            for page_id, url, refers_to, payload in zip(*(batch.column(c) for c in names)):
                raw = payload.as_py()
                data = record_bytes(page_id.as_py(), url.as_py(), raw.encode() if raw is not None else b"", refers_to.as_py())
                held.append(gzip.compress(data, 6, mtime=0))
                size += len(held[-1])
                if size >= SEGMENT_BYTES:
                    yield segment()
                    held, size = [], 0
        if held:
            yield segment()

    rows = with_revisits(pages, id_col, payload_col, min_bytes).select(
        F.col(id_col), F.col(url_col).cast("string"), "refers_to", F.col(payload_col).cast("string")
    )
    segments = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    segments.write.option("lineSep", "\0").option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(folder)


# --- reading -------------------------------------------------------------------------


class BadRecord(ValueError):
    pass


def parse_record(data: memoryview) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, length) of the record at the start of ``data``; raises BadRecord."""
    window = _CHUNK
    head = bytes(data[:window])
    version = _VERSION.match(head)
    if not version:
        raise BadRecord("no version line")
    while (close := head.find(b"\r\n\r\n")) < 0:
        if window >= len(data):
            raise BadRecord("headers do not end")
        window *= 4
        head = bytes(data[:window])
    headers = {}
    for line in head[version.end() : close].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            raise BadRecord("malformed header")
        headers[name.strip().lower()] = value.strip()
    if not all(headers.get(name) for name in _MANDATORY):
        raise BadRecord("a mandatory header is missing")
    if not headers["content-length"].isdecimal():
        raise BadRecord("content length is no number")
    begin, size = close + 4, int(headers["content-length"])
    if begin + size + 4 > len(data):
        raise BadRecord("record is cut off")
    block = bytes(data[begin : begin + size])
    if bytes(data[begin + size : begin + size + 4]) != b"\r\n\r\n":
        raise BadRecord("record does not end where its length says")
    if headers.get("warc-block-digest", "sha1:").startswith("sha1:"):
        named = headers.get("warc-block-digest", "")[5:]
        if named and named != base32_sha1(block):
            raise BadRecord("block digest differs")
    if headers.get("warc-type") == "response":
        named = headers.get("warc-payload-digest", "")
        if named.startswith("sha1:") and named[5:] != base32_sha1(payload_of(block)):
            raise BadRecord("payload digest differs")
    return headers, block, begin + size + 4


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP header of a response block, or the whole block without one."""
    return block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block


def _member(data: memoryview, at: int) -> tuple[bytes, int, str]:
    """What the gzip member at ``at`` holds before its first fault, where it ends, and the fault or nothing."""
    unpack, parts, place = zlib.decompressobj(31), [], at
    while not unpack.eof:
        if place >= len(data):
            return b"".join(parts), place, "member is cut off"
        piece, before = data[place : place + _CHUNK], unpack.copy()
        try:
            parts.append(unpack.decompress(piece))
        except zlib.error as error:
            for k in range(len(piece)):  # again, up to the byte at fault
                try:
                    parts.append(before.decompress(piece[k : k + 1]))
                except zlib.error:
                    break
            return b"".join(parts), place, f"member is damaged: {error}"
        place += len(piece)
    return b"".join(parts), place - len(unpack.unused_data), ""


def _has_digest(headers: dict[str, str]) -> bool:
    named = ["warc-block-digest"] + ["warc-payload-digest"] * (headers.get("warc-type") == "response")
    return any(headers.get(x, "").startswith("sha1:") and len(headers[x]) > 5 for x in named)


def _inside(content: bytes, damaged: bool) -> tuple[list[tuple[dict[str, str], bytes]], list[tuple[int, int, str]]]:
    """The valid records of a member's content and its gaps (begin, end, reason).

    What decompresses before a fault may be wrong unnoticed, so in a damaged member
    only records with a digest count.
    """
    data, records, gaps, at = memoryview(content), [], [], 0

    def parse(place: int) -> tuple[dict[str, str], bytes, int]:
        made = parse_record(data[place:])
        if damaged and not _has_digest(made[0]):
            raise BadRecord("record without a digest in a damaged member")
        return made

    while at < len(data):
        try:
            headers, block, length = parse(at)
        except BadRecord as error:
            reason, start, at = str(error), at, len(data)
            for opening in _VERSION.finditer(content, start + 1):
                try:
                    parse(opening.start())
                except BadRecord:
                    continue
                at = opening.start()
                break
            gaps.append((start, at, reason))
            continue
        records.append((headers, block))
        at += length
    return records, gaps


Found = tuple[list[tuple[dict[str, str], bytes]], int, list[tuple[int, int, str]], str]


def read_at(data: memoryview, at: int) -> Found:
    """The member or plain record at ``at``: its records, where it ends, the gaps in its content, the fault of the member.

    Raises BadRecord where no record is valid. Of a damaged member the end is not
    known; what is given is where it was found to be damaged.
    """
    if bytes(data[at : at + 3]) != _MAGIC:
        headers, block, length = parse_record(data[at:])
        return [(headers, block)], at + length, [], ""
    content, end, fault = _member(data, at)
    records, gaps = _inside(content, bool(fault))
    if not records and (fault or gaps):
        raise BadRecord(fault or gaps[0][2])
    return records, end, gaps, fault


def salvage(content: bytes) -> Iterator[tuple[int, int, str, list[tuple[dict[str, str], bytes]]]]:
    """(offset, length, reason, records) over a whole archive: records without reason, or a gap with one.

    Valid members and records and the gaps cover every byte, in order. The place a
    gap ends at is where a read succeeds, so a chance magic number inside damaged
    bytes does not count. A gap in the content of a member has the member's offset,
    length 0, and its place in the content in the reason. The records of a damaged
    member also have length 0; the gap over its bytes comes after them.
    """
    data, at = memoryview(content), 0
    found: Found | None = None
    while at < len(data):
        try:
            records, end, gaps, reason = found or read_at(data, at)
            for a, b, why in gaps:
                yield at, 0, f"{why} (bytes {a} to {b} of the content)", []
            if not reason:
                yield at, end - at, "", records
                at, found = end, None
                continue
            yield at, 0, "", records
        except BadRecord as error:
            reason = str(error)
        start, at, found = at, len(data), None
        for opening in _OPENING.finditer(content, start + 1):
            try:
                found = read_at(data, opening.start())
            except BadRecord:
                continue
            at = opening.start()
            break
        yield start, at - start, reason, []


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """All records and gaps of the archives below ``folder`` (see RECORDS).

    ``kind`` is record or gap. Gaps name path, offset, length and reason and have
    nulls elsewhere. ``payload_bytes`` and ``payload_digest`` describe the full
    payload, of revisits as well: the HTTP header and the digest header keep them.
    One task reads a file whole, so archives should be a few hundred MB at most; the
    writer here keeps them near 16 MB.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("kind", pa.string()),
            ("reason", pa.string()), ("warc_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
            ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
        ])
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows, size = [], 0
                for offset, length, reason, records in salvage(content.as_py()):
                    if reason:
                        rows.append((path.as_py(), offset, length, "gap", reason, *[None] * 7))
                    for headers, block in records:
                        payload = payload_of(block)
                        told = re.search(rb"\r\ncontent-length: *(\d+)", block.partition(b"\r\n\r\n")[0], re.I)
                        n = int(told[1]) if headers.get("warc-type") == "revisit" and told else len(payload)
                        digest = headers.get("warc-payload-digest", "").partition(":")[2] or base32_sha1(payload)
                        rows.append((
                            path.as_py(), offset, length, "record", None, headers.get("warc-type"),
                            headers.get("warc-record-id"), headers.get("warc-target-uri"), headers.get("warc-refers-to"),
                            digest, n, payload if with_payload and headers.get("warc-type") != "revisit" else None,
                        ))
                        size += len(payload) if with_payload else 0
                    if size > SEGMENT_BYTES or len(rows) > 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "content").mapInArrow(run, RECORDS)


def id_of(column: str) -> Column:
    """The page id in a record id, null if there is none."""
    found = F.regexp_extract(F.col(column), f"<{ID_PREFIX}(.*)>", 1)
    return F.when(found != "", found.cast("long"))


def archive_round_trip(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0
) -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and reads them back.

    Per row: the id, payload_bytes, payload_digest (bare base32), record_type and
    refers_to, all from the archives. Repeated rows of the largest id are each a
    response. Null ids come back null. Other columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archives(pages, folder, id_col, url_col, payload_col, min_bytes)
    records = read_archives(spark, folder, with_payload=False).where("kind = 'record'")
    return records.select(
        id_of("record_id").alias(id_col), "payload_bytes", "payload_digest",
        F.col("warc_type").alias("record_type"), id_of("refers_to").alias("refers_to"),
    )
