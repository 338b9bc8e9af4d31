"""Web archives: writing ARC files, and converting them to WARC files.

An ARC file begins with a version block; version 1 records have a header line of five fields, version 2 of ten, and both
end it with the length of what follows. The converter reads the version from the block, parses each header line
accordingly, takes the declared length, and synthesises what a WARC record has besides: an identifier (a name-based
UUID), the timestamp in the newer form, the type and the digests. Of records with equal payloads one is the response and
the others are revisits that refer to it.

Archives are written and read by Spark's text and binary-file sources, so they may lie in any store that Spark reaches.
A row of the text source is one archive of about CHUNK_BYTES, written to a file of its own and compressed; readers
decompress and parse it record by record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.llm.scratch import folder, save

CHUNK_BYTES = 16_000_000
ARCHIVE_DATE = "20240101000000"
VERSION_LINES = {
    1: b"1 0 reelstat\nURL IP-address Archive-date Content-type Archive-length\n",
    2: b"2 0 reelstat\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n",
}
PAYLOAD_TYPES = "page_id long, url string, payload_bytes long, payload_digest string, same string, record_type string, refers_to long"


def _url_field(url: str | None) -> str:
    """A header line is split at spaces, so white space in a url is escaped; no url at all is '-'."""
    return re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "-")


def arc_record(url: str | None, page_id: int | None, payload: bytes, version: int, offset: int) -> bytes:
    """A response of a web server as an ARC record, without the line feed after it."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if page_id is None else page_id}\r\n\r\n"
    block = head.encode() + payload
    fields = [_url_field(url), "0.0.0.0", ARCHIVE_DATE, "text/html"]
    if version == 2:
        fields += ["200", "-", "-", str(offset), "pages.arc"]
    return " ".join([*fields, str(len(block))]).encode() + b"\n" + block


def _arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of records, each a whole archive. Versions alternate, so that both kinds of header are read."""
    version, parts, size = 1, [], 0

    def chunk():
        return pa.RecordBatch.from_arrays([pa.array([b"\n".join(parts)], pa.binary())], ["value"])

    for batch in batches:
        for page_id, url, html in zip(*(batch.column(n) for n in ("page_id", "url", "html"))):
            if not parts:
                description = b"filedesc://pages.arc 0.0.0.0 %s text/plain %%s%%d\n" % ARCHIVE_DATE.encode()
                more = b"200 - - 0 pages.arc " if version == 2 else b""
                parts = [description % (more, len(VERSION_LINES[version])) + VERSION_LINES[version]]
                size = len(parts[0])
            payload = (html.as_py() or "").encode("utf-8")
            parts.append(arc_record(url.as_py(), page_id.as_py(), payload, version, size))
            size += len(parts[-1]) + 1
            if size >= CHUNK_BYTES:
                yield chunk()
                version, parts = 3 - version, []
    if parts:
        yield chunk()


def inflated(content: bytes) -> bytes:
    """The bytes of a file that may be gzip, of one member or several."""
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content) + member.flush())
        content = member.unused_data
    return b"".join(out) if out else content


def parse_arc(data: bytes) -> Iterator[tuple[str, str, str, bytes]]:
    """(url, date, content type, block) of each record after the version block, by the declared lengths."""
    at, version = 0, None
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            break
        line = data[at:end].strip()
        at = end + 1
        if not line:  # the line feed between records
            continue
        fields = line.decode("utf-8").split(" ")
        block = data[at : at + int(fields[-1])]
        at += len(block)
        if version is None:
            version = int(block.split(b" ", 1)[0])
            continue
        if len(fields) != {1: 5, 2: 10}[version]:
            raise ValueError(f"{len(fields)} header fields in an ARC file of version {version}")
        yield fields[0], fields[2], fields[3], block


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def identifier(url: str, date: str, page_id: int | None) -> str:
    """The same for the same record in every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {page_id}')}>"


def _split_http(block: bytes) -> tuple[bytes, bytes, int | None]:
    head, _, payload = block.partition(b"\r\n\r\n")
    found = re.search(rb"(?im)^x-page-id: *(-?\d+)\r?$", head)
    return head + b"\r\n\r\n", payload, int(found[1]) if found else None


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for _, _, _, block in parse_arc(inflated(content.as_py())):
                _, payload, page_id = _split_http(block)
                rows.append((page_id, len(payload), hashlib.sha256(payload).hexdigest()))
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "payload_bytes", "same"])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for url, date, _, block in parse_arc(inflated(content.as_py())):
                head, payload, page_id = _split_http(block)
                rows.append((page_id, url, date, head, payload, hashlib.sha256(payload).hexdigest()))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.string())
            names = ["page_id", "url", "date", "head", "payload", "same"]
            for start in range(0, len(rows), 256):  # small batches, as each row holds a page
                part = rows[start : start + 256]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], t) for i, t in enumerate(kinds)], names)


def warc_record(url: str, date: str, page_id: int | None, head: bytes, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit that keeps the server's header alone, without the blank lines after it."""
    when = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.0",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {identifier(url, date, page_id)}",
        f"WARC-Date: {when}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines.insert(6, "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")
        lines.insert(7, f"X-Refers-To-Page: {refers_to}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def _warcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, size = [], 0
    names = ("url", "date", "page_id", "head", "payload", "refers_to")
    for batch in batches:
        for values in zip(*(batch.column(n) for n in names)):
            parts.append(warc_record(*(v.as_py() for v in values)))
            size += len(parts[-1])
            if size >= CHUNK_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(parts)], pa.binary())], ["value"])
                parts, size = [], 0
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(parts)], pa.binary())], ["value"])


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named fields, block) of each record, by the declared lengths."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            break
        lines = data[at:end].decode("utf-8").split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        block = data[end + 4 : end + 4 + int(fields["Content-Length"])]
        at = end + 8 + len(block)  # a record ends in two line ends
        yield fields, block


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for fields, block in parse_warc(inflated(content.as_py())):
                head, payload, page_id = _split_http(block)
                declared, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                if kind == "response" and digest(payload) != declared:
                    raise ValueError(f"payload digest of {fields['WARC-Record-ID']} differs")
                refers = fields.get("X-Refers-To-Page")
                rows.append((page_id, int(fields["X-Payload-Length"]), declared, kind, None if refers is None else int(refers)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)


def _write(chunks: DataFrame, path: str, line_end: str) -> None:
    """One file per chunk. The line end closes its last record."""
    text = chunks.select(F.col("value").cast("string").alias("value"))
    writer = text.write.option("lineSep", line_end).option("maxRecordsPerFile", 1).option("compression", "gzip")
    writer.option("zlib.compress.level", "BEST_SPEED").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def write_arc(pages: DataFrame, path: str) -> None:
    """The pages (page_id, url, html) as ARC files of both versions; null html: an empty payload."""
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    _write(source.mapInArrow(_arcs, "value binary"), path, "\n")


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 0) -> None:
    """ARC files to WARC files. Records of equal payloads of at least `least_bytes` are revisits of that with the largest
    page id; records that share that id too are all responses, and so are all where no record has an id.

    Payloads are told apart by SHA-256. Only the digests of payloads that occur more than once are joined to the records.
    """
    seen = _files(spark, arc_path).mapInArrow(_digests, "page_id long, payload_bytes long, same string")
    groups = seen.where(F.col("payload_bytes") >= least_bytes).groupBy("same")
    targets = save(groups.agg(F.count("*").alias("n"), F.max("page_id").alias("target")).where("n > 1").select("same", "target"))
    schema = "page_id long, url string, date string, head binary, payload binary, same string"
    records = _files(spark, arc_path).mapInArrow(_records, schema).join(targets, "same", "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("target")), F.col("target")).alias("refers_to")
    chunks = records.select("url", "date", "page_id", "head", "payload", refers_to).mapInArrow(_warcs, "value binary")
    _write(chunks, warc_path, "\r\n\r\n")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per record; digests of responses are verified."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return _files(spark, path).mapInArrow(_read, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """The pages written as ARC, converted to WARC and read back, in the shared folder."""
    spark = pages.sparkSession
    arc_path, warc_path = folder(spark), folder(spark)
    write_arc(pages, arc_path)
    convert(spark, arc_path, warc_path)
    return read_warc(spark, warc_path)
