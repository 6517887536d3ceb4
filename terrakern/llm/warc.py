"""WARC archives: a writer of plain Spark expressions and a salvage reader.

The writer makes one WARC/1.1 record per page, each a gzip member of its own, and
lets Spark's text writer put them on whatever file system the folder is on; an empty
gzip member, which adds nothing to the content, separates the records.  The reader
takes whole files (gzip of one or many members, or plain), and where a check fails it looks
for the next valid gzip member or version line, goes on from there, and logs the
bytes in between as a quarantined gap.
"""

from __future__ import annotations

import hashlib
import logging
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrakern.llm.common import bounded_batches, shared_dir, stage

#: Payloads under this many bytes are never deduplicated.
LEAST_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/\d\.\d\r?\n")
FEED = 1 << 16
#: Fixed value: a gzip member of nothing.
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + bytes(8)
#: Archives aim at this many bytes of payload, so that a reader's task holds one of them.
FILE_BYTES = 32 << 20


# -- writing -------------------------------------------------------------------
def _header_value(value: Column) -> Column:
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"[\x00-\x1f]", " ")


def with_references(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Add payload_digest, payload_bytes and refers_to (the id of the equal payload's first page).

    ``refers_to`` is null for payloads under LEAST_REVISIT bytes, for payloads that
    occur once and for the smallest id itself.  A null id is never referred to; rows
    that share the smallest id are all first.  Digests are grouped without the
    payloads, and the pages are joined back by id and digest, so a payload that a
    third of the pages share is no hot key.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.withColumn("payload_digest", F.sha2(payload.cast("binary"), 256)).withColumn("payload_bytes", F.octet_length(payload).cast("long"))
    marks = rows.select(id_col, "payload_digest", "payload_bytes").distinct()
    firsts = marks.filter(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("payload_digest").agg(F.min(id_col).alias("first"), F.count("*").alias("n"))
    firsts = firsts.filter((F.col("n") > 1) & F.col("first").isNotNull()).select("payload_digest", "first")
    later = marks.join(firsts, "payload_digest").filter(~F.col(id_col).eqNullSafe(F.col("first")))
    later = later.select(F.col(id_col).alias("__id"), F.col("payload_digest").alias("__digest"), F.col("first").alias("refers_to"))
    return rows.join(later, rows[id_col].eqNullSafe(later["__id"]) & (rows["payload_digest"] == later["__digest"]), "left").drop("__id", "__digest")


def record_text(id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> Column:
    """A whole record but for its closing blank lines, from the columns of :func:`with_references`."""
    revisit = F.col("refers_to").isNotNull()
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(revisit, F.lit("")).otherwise(F.coalesce(F.col(html_col), F.lit("")))
    length = F.octet_length(head) + F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("payload_bytes"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    lines = [
        F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col(id_col))),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), _header_value(F.col(url_col))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("refers_to")), F.lit(f"\r\nWARC-Profile: {PROFILE}"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), head, body)


def gzip_member(record: bytes) -> bytes:
    """The record with its closing blank lines as one gzip member."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    whole = record + b"\r\n\r\n"
    return EMPTY_MEMBER[:10] + packer.compress(whole) + packer.flush() + struct.pack("<II", zlib.crc32(whole), len(whole) & 0xFFFFFFFF)


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", records_per_file: int | None = None) -> None:
    """Write one record per page, a gzip member each, into archives in ``folder`` (any file system of Spark's).

    Equal payloads of at least LEAST_REVISIT bytes are written once, by the smallest
    id; the others become revisit records.  Null html is an empty payload, a null url
    an empty one; other columns are not read.  Unless ``records_per_file`` is given,
    files aim at FILE_BYTES by the mean size of a page.
    """
    if records_per_file is None:
        size = pages.agg(F.sum(F.octet_length(html_col)).alias("bytes"), F.count("*").alias("n")).first()
        records_per_file = max(1, FILE_BYTES // (1000 + (size["bytes"] or 0) // max(1, size["n"])))
    bounded_batches(pages.sparkSession, 500)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([gzip_member(r) for r in batch.column(0).to_pylist()], pa.binary())], ["value"])

    rows = with_references(pages.select(id_col, url_col, html_col), id_col, html_col)
    members = rows.select(record_text(id_col, url_col, html_col).cast("binary").alias("value")).mapInArrow(pack, "value binary")
    # a cast from binary keeps the bytes as they are, and so does the writer
    out = members.select(F.col("value").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
    out.option("compression", "none").option("maxRecordsPerFile", records_per_file).text(folder)


# -- reading -------------------------------------------------------------------
class Found(NamedTuple):
    """A record, or (reason set) a quarantined gap; offsets are those of the stream named."""

    stream: int
    offset: int
    length: int
    reason: str | None
    headers: dict[str, str]
    payload: bytes


def streams(content: bytes) -> Iterator[tuple[int, bytes, int, str | None]]:
    """Decompressed runs of a file: (offset, data, compressed length, None), or gaps with their reason."""
    at = 0
    while at < len(content):
        if not content.startswith(MEMBER, at):
            following = content.find(MEMBER, at)
            while following >= 0 and not _is_member(content, following):
                following = content.find(MEMBER, following + 1)
            end = following if following >= 0 else len(content)
            if VERSION.search(content, at, end):
                yield at, content[at:end], end - at, None
            else:
                yield at, b"", end - at, "neither a gzip member nor a version line"
            at = end
            continue
        member, out, fed = zlib.decompressobj(wbits=31), [], at
        try:
            while fed < len(content) and not member.eof:
                out.append(member.decompress(content[fed : fed + FEED]))
                fed += FEED
            reason = None if member.eof else "gzip member ends early"
        except zlib.error as e:
            reason = f"gzip: {e}"
        data = b"".join(out)
        if reason is None:
            end = min(fed, len(content)) - len(member.unused_data)
            yield at, data, end - at, None
        else:
            following = content.find(MEMBER, at + 1)
            while following >= 0 and not _is_member(content, following):
                following = content.find(MEMBER, following + 1)
            end = following if following >= 0 else len(content)
            yield at, data, end - at, None
            yield at, b"", end - at, reason
        at = end


def _is_member(content: bytes, at: int) -> bool:
    """Whether a gzip member that starts at ``at`` can be read for a while."""
    try:
        return bool(zlib.decompressobj(wbits=31).decompress(content[at : at + FEED], 64))
    except zlib.error:
        return False


def parse_record(data: bytes, at: int) -> tuple[int, dict[str, str], bytes] | str:
    """The record at ``at``: where it ends, its headers, its payload; or why it isn't valid."""
    version = VERSION.match(data, at)
    if not version:
        return "no version line"
    split = data.find(b"\r\n\r\n", at)
    if split < 0:
        return "headers do not end"
    headers = {}
    for line in data[version.end() : split].split(b"\r\n"):
        key, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            return "malformed header"
        headers[key.strip().lower()] = value.strip()
    if not headers.get("content-length", "").isdigit() or not {"warc-type", "warc-record-id"} <= headers.keys():
        return "a mandatory header is missing"
    start = split + 4
    end = start + int(headers["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        return "block does not end where it should"
    block = data[start:end]
    payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
    said = headers.get("warc-payload-digest", "")
    if headers["warc-type"] != "revisit" and said.startswith("sha256:") and hashlib.sha256(payload).hexdigest() != said[7:]:
        return "payload digest differs"
    return end + 4, headers, payload


def salvage(content: bytes) -> Iterator[Found]:
    """All valid records of a file, and the gaps between them."""
    for start, data, size, reason in streams(content):
        if reason:
            yield Found(start, 0, size, reason, {}, b"")
            continue
        at = 0
        while at < len(data):
            got = parse_record(data, at)
            if not isinstance(got, str):
                yield Found(start, at, got[0] - at, None, got[1], got[2])
                at = got[0]
                continue
            following = VERSION.search(data, at + 1)
            while following and isinstance(parse_record(data, following.start()), str):
                following = VERSION.search(data, following.start() + 1)
            end = following.start() if following else len(data)
            if data[at:end].strip():
                yield Found(start, at, end - at, got, {}, b"")
            at = end


SCHEMA = "path string, stream long, offset long, length long, gap string, record_type string, record_id string, uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def read_warc(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per valid record and per quarantined gap of the files (columns path, content).

    ``files`` is what ``spark.read.format("binaryFile")`` gives.  ``gap`` holds the
    reason for a gap and is null for a record; ``stream`` is the byte offset of the
    gzip member (or plain run) in the file, ``offset`` that within its content.  For
    revisits, digest and length are those that the record states of the full
    payload.  Null and empty contents give no row.
    """
    bounded_batches(files.sparkSession, 8)
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def rows(path: str, content: bytes) -> Iterator[tuple]:
        for x in salvage(content):
            h = x.headers
            if x.reason:
                yield (path, x.stream, x.offset, x.length, x.reason, *[None] * 7)
                continue
            said = h.get("warc-payload-digest", "")
            revisit = h["warc-type"] == "revisit"
            digest = said[7:] if revisit and said.startswith("sha256:") else hashlib.sha256(x.payload).hexdigest()
            size = int(h["x-payload-length"]) if revisit and h.get("x-payload-length", "").isdigit() else len(x.payload)
            yield (path, x.stream, x.offset, x.length, None, h["warc-type"], h["warc-record-id"], h.get("warc-target-uri"), h.get("warc-refers-to"), digest, size, x.payload if with_payload else None)

    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = []
                for row in rows(path, content.as_py() or b""):
                    held.append(row)
                    if len(held) == 500:
                        yield _batch(held, names, kinds)
                        held = []
                if held:
                    yield _batch(held, names, kinds)

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def quarantined(found: DataFrame) -> DataFrame:
    """The gaps among what :func:`read_warc` found: path, stream, offset, length, gap."""
    return found.filter(F.col("gap").isNotNull()).select("path", "stream", "offset", "length", "gap")


def salvage_folder(spark: SparkSession, folder: str, with_payload: bool = True) -> tuple[DataFrame, DataFrame, int]:
    """Read all archives of a folder: the records, the log of gaps, and how many gaps there are.

    Both are staged tables in the shared folder, so the files are read once; every
    gap is a row of the log, and their number and bytes go to Python's log as well.
    """
    found = stage(read_warc(spark.read.format("binaryFile").load(folder), with_payload), "warc-found")
    log = quarantined(found)
    lost = log.agg(F.count("*").alias("gaps"), F.sum("length").alias("bytes"), F.count_distinct("path").alias("files")).first()
    if lost["gaps"]:
        logging.getLogger(__name__).warning("%s gaps of %s bytes quarantined in %s files of %s", lost["gaps"], lost["bytes"], lost["files"], folder)
    return found.filter(F.col("gap").isNull()).drop("gap"), log, lost["gaps"]


def archive_round_trip(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back, one row per record.

    These archives are our own, so a gap means lost pages: it raises RuntimeError.
    """
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, folder, id_col, url_col, html_col)
    found, _, gaps = salvage_folder(spark, folder, with_payload=False)
    if gaps:
        raise RuntimeError(f"{gaps} gaps in the archives just written to {folder}")
    return found.select(page_of(F.col("record_id")).alias(id_col), "payload_bytes", "payload_digest", "record_type", page_of(F.col("refers_to")).alias("refers_to"))
