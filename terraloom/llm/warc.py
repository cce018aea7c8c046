"""Legacy web archives to WARC: version-specific ARC headers in, WARC records with made-up-once identifiers, types and digests out.

Archives are real gzip files in a folder.  Records are produced by tasks, written by Spark's text writer with the record separator as line
end, and read back whole file by whole file; files are kept to a few megabytes, so no task holds more than a few of them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.llm.common import as_batch, forget, shared_path, stored, text_bytes

ARCHIVE_BYTES = 8 << 20
BATCH_BYTES = 4 << 20
DATE = "20240101000000"  # of pages, which carry none
# Names of the header fields of both ARC versions, and of WARC's revisit profile.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length".split(),
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length".split(),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_HEADER = "X-Page-Id"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the namespace of URLs
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def unzipped(data: bytes) -> bytes:
    """Content of a gzip file of any number of members; other files as they are."""
    if data[:2] != b"\x1f\x8b":
        return data
    parts = []
    while data:
        member = zlib.decompressobj(31)
        parts.append(member.decompress(data) + member.flush())
        data = member.unused_data.lstrip(b"\0")
    return b"".join(parts)


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Status line and headers with the blank line after them, and the payload; no headers if the block is no HTTP response."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    cut = re.search(rb"\r?\n\r?\n", block)
    return (block[: cut.end()], block[cut.end():]) if cut else (block, b"")


def http_header(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


@dataclass
class ArcRecord:
    archive: str
    offset: int
    fields: dict[str, str]
    block: bytes
    head: bytes = field(init=False)
    payload: bytes = field(init=False)

    def __post_init__(self):
        self.head, self.payload = split_http(self.block)

    @property
    def uri(self) -> str:
        return self.fields["URL"]

    @property
    def date(self) -> str:
        """WARC form of the archive date, which has 4 to 14 digits."""
        d = (re.sub(r"\D", "", self.fields["Archive-date"]) + "00000101000000"[len(re.sub(r"\D", "", self.fields["Archive-date"])):])[:14]
        return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"

    @property
    def record_id(self) -> str:
        """The same for every reading of the same record."""
        return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{self.archive} {self.offset} {self.uri} {self.date}')}>"


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file of version 1 or 2, by the field names and lengths it declares; the version block is not returned.

    Addresses may hold spaces, so fields are counted from the right.  A declared length that the file does not hold is an error.
    """
    end = data.find(b"\n")
    if end < 0:
        return
    first = data[:end].decode("utf-8", "replace").rstrip("\r")
    if not first.startswith("filedesc://"):
        raise ValueError(f"no ARC version block: {first[:80]!r}")
    archive = first.split(" ", 1)[0].removeprefix("filedesc://")
    size = int(first.rsplit(" ", 1)[1])
    about = data[end + 1: end + 1 + size].decode("utf-8", "replace").splitlines()
    version = int(about[0].split()[0])
    names = about[1].split() if len(about) > 1 and about[1].strip() else ARC_FIELDS[version]
    if names != ARC_FIELDS.get(version):
        raise ValueError(f"ARC version {version} with fields {names}")
    at = end + 1 + size
    while True:
        while data[at: at + 1] in (b"\n", b"\r"):
            at += 1
        end = data.find(b"\n", at)
        if end < 0:
            return
        values = data[at:end].decode("utf-8", "replace").rstrip("\r").rsplit(" ", len(names) - 1)
        fields = dict(zip(names, values, strict=True))
        size = int(fields["Archive-length"])
        block = data[end + 1: end + 1 + size]
        if len(block) != size:
            raise ValueError(f"{archive}: record at {at} declares {size} bytes and has {len(block)}")
        yield ArcRecord(archive, at, fields, block)
        at = end + 1 + size


def arc_version_block(archive: str, version: int) -> bytes:
    about = f"{version} 0 terraloom\n{' '.join(ARC_FIELDS[version])}\n".encode()
    extra = " 200 - - 0 " + archive if version == 2 else ""
    return f"filedesc://{archive} 0.0.0.0 {DATE} text/plain{extra} {len(about)}\n".encode() + about


def arc_record(version: int, archive: str, url: str, block: bytes, date: str = DATE) -> bytes:
    plain = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) or "-"
    extra = f" 200 - - 0 {archive}" if version == 2 else ""
    return f"{plain} 0.0.0.0 {date} text/html{extra} {len(block)}\n".encode() + block


def http_response(payload: bytes, page: int | None) -> bytes:
    named = "" if page is None else f"{PAGE_HEADER}: {page}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{named}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


_RECORD = pa.schema([("record", pa.binary())])


def _packed(records: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    block, size = [], 0
    for record in records:
        block.append((record,))
        size += len(record)
        if size >= BATCH_BYTES:
            yield as_batch(_RECORD, block)
            block, size = [], 0
    if block:
        yield as_batch(_RECORD, block)


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Pages as gzip ARC files of about ``ARCHIVE_BYTES``: even ones of version 1, odd ones of version 2."""
    rows = pages.select(
        F.col(key).cast("bigint").alias("page"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), text_bytes(F.col(html)).alias("payload"))
    size = rows.agg(F.sum(F.octet_length("payload") + 300)).first()[0] or 0

    def write(batches):
        number = TaskContext.get().partitionId()
        archive, version = f"pages-{number:06d}.arc", 1 + number % 2

        def records():
            first = True
            for batch in batches:
                for page, address, payload in zip(*(batch.column(c) for c in ("page", "url", "payload")), strict=True):
                    if first:
                        yield arc_version_block(archive, version)
                        first = False
                    yield arc_record(version, archive, address.as_py(), http_response(payload.as_py(), page.as_py()))

        yield from _packed(records())

    texts = rows.repartition(max(1, -(-size // ARCHIVE_BYTES))).mapInArrow(write, "record binary")
    texts.select(F.col("record").cast("string")).write.options(lineSep="\n", **GZIP).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _each_file(batches) -> Iterator[tuple]:
    for batch in batches:
        for row in range(len(batch)):
            yield tuple(column[row].as_py() for column in batch.columns)


_HEADS = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("page", pa.int64()), ("digest", pa.string()), ("size", pa.int64()), ("record_id", pa.string()),
    ("uri", pa.string()), ("date", pa.string())])


def arc_heads(spark: SparkSession, path: str) -> DataFrame:
    """What is to be known of every record of the ARC files before types are given: where it is, its digest, its identifier."""
    def read(batches):
        for name, content in _each_file(batches):
            rows = [(name, r.offset, _page(r.head), sha1_base32(r.payload), len(r.payload), r.record_id, r.uri, r.date) for r in parse_arc(unzipped(content))]
            yield as_batch(_HEADS, rows)
    return _files(spark, path).mapInArrow(
        read, "path string, offset bigint, page bigint, digest string, size bigint, record_id string, uri string, date string")


def _page(head: bytes) -> int | None:
    value = http_header(head, PAGE_HEADER)
    return None if value is None else int(value)


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC record without the two line ends behind it."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def convert_record(record: ArcRecord, response: tuple[str, str, str] | None) -> bytes:
    """A response, or a revisit of the record of which identifier, address and date are given; that keeps the HTTP headers only."""
    block = record.block if response is None else record.head
    headers = [
        ("WARC-Record-ID", record.record_id), ("WARC-Target-URI", record.uri), ("WARC-Date", record.date),
        ("WARC-IP-Address", record.fields["IP-address"]), ("WARC-Payload-Digest", f"sha1:{sha1_base32(record.payload)}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("Content-Type", "application/http; msgtype=response" if record.head else record.fields["Content-type"])]
    if response is None:
        return warc_record("response", headers, block)
    headers += [
        ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", response[0]), ("WARC-Refers-To-Target-URI", response[1]),
        ("WARC-Refers-To-Date", response[2])]
    return warc_record("revisit", headers, block)


def convert_arc(spark: SparkSession, arc_path: str, warc_path: str, least: int = 0) -> None:
    """WARC files for the ARC files of a folder, one for one.

    Of records with equal payloads of at least ``least`` bytes the one of the smallest page (without a number last, then by place) is the
    response, the others revisit it.  Types are settled on digests; payloads are not shuffled, only whole compressed archives.
    """
    heads = stored(arc_heads(spark, arc_path), "arc-heads")
    order = F.struct(F.col("page").isNull(), F.col("page"), F.col("uri"), F.col("record_id"), F.col("date"))
    firsts = stored(heads.where(F.col("size") >= least).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
                    .where("n > 1").select("digest", "first.record_id", "first.uri", "first.date"), "arc-firsts")
    again = heads.where(F.col("size") >= least).select("path", "offset", "digest", F.col("record_id").alias("own")).join(firsts, "digest")
    again = again.where(F.col("own") != F.col("record_id")).groupBy("path").agg(
        F.collect_list(F.struct("offset", "record_id", "uri", "date")).alias("revisits"))
    files = _files(spark, arc_path).join(again, "path", "left")

    def write(batches):
        def records():
            for _, content, revisits in _each_file(batches):
                known = {r["offset"]: (r["record_id"], r["uri"], r["date"]) for r in revisits or ()}
                about = True
                for record in parse_arc(unzipped(content)):
                    if about:
                        yield warcinfo(record.archive, record.date)
                        about = False
                    yield convert_record(record, known.get(record.offset))
        yield from _packed(records())

    texts = files.mapInArrow(write, "record binary")
    texts.select(F.col("record").cast("string")).write.options(lineSep="\r\n\r\n", **GZIP).text(warc_path)


def warcinfo(archive: str, date: str) -> bytes:
    block = f"software: terraloom\r\nformat: WARC File Format 1.1\r\nconverted-from: {archive}\r\n".encode()
    name = f"<urn:uuid:{uuid.uuid5(NAMESPACE, archive)}>"
    return warc_record("warcinfo", [("WARC-Record-ID", name), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], block)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record, by declared lengths."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        size = int(headers["content-length"])
        block = data[end + 4: end + 4 + size]
        if len(block) != size or data[end + 4 + size: end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} does not end where it declares")
        yield headers, block
        at = end + 8 + size


_READ = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()),
    ("response_id", pa.string()), ("uri", pa.string()), ("date", pa.string()), ("payload", pa.binary())])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits of the WARC files of a folder; a revisit has no payload, its size is that which its headers declare.

    A digest that does not fit its payload or block is an error.
    """
    def read(batches):
        for _, content in _each_file(batches):
            block, size = [], 0
            for headers, body in parse_warc(unzipped(content)):
                if headers["warc-type"] not in ("response", "revisit"):
                    continue
                head, payload = split_http(body)
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                whole = headers["warc-type"] == "response"
                if sha1_base32(body) != headers["warc-block-digest"].removeprefix("sha1:") or whole and sha1_base32(payload) != digest:
                    raise ValueError(f"digest of {headers['warc-record-id']}")
                length = len(payload) if whole else int(http_header(head, "Content-Length") or 0)
                block.append((
                    _page(head), length, digest, headers["warc-type"], headers["warc-record-id"], headers.get("warc-refers-to"),
                    headers["warc-target-uri"], headers["warc-date"], payload if whole else None))
                size += len(payload)
                if size >= BATCH_BYTES:
                    yield as_batch(_READ, block)
                    block, size = [], 0
            if block:
                yield as_batch(_READ, block)
    return _files(spark, path).mapInArrow(
        read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, record_id string, response_id string, "
        "uri string, date string, payload binary")


def archived_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Write pages as ARC, convert them to WARC, read those back: one row per page with its digest, type and response.

    A null html is an empty payload; a null address is written as ``-``; a page without a number never is the response of a numbered one;
    of repeated rows one is the response; no pages give no rows.
    """
    spark = pages.sparkSession
    arcs, warcs = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages, arcs, key, url, html)
    convert_arc(spark, arcs, warcs, least)
    forget(spark, arcs)
    read = stored(read_warc(spark, warcs).drop("payload", "uri", "date"), "warc-index")
    responses = read.where("record_type = 'response'").select(F.col("record_id").alias("response_id"), F.col("page_id").alias("refers_to"))
    plain = read.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("bigint"))
    joined = read.where("record_type = 'revisit'").join(responses, "response_id", "left")
    names = ["payload_bytes", "payload_digest", "record_type", "refers_to"]
    return plain.unionByName(joined).select(F.col("page_id").alias(key), *names)


ORACLE = """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages),
bits AS (
  SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: substr(
    ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']
    [instr('0123456789abcdef', substr(hex, i::INT, 1))], 1, 4)), 'string_agg', '') AS digits FROM sized)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + 16 * substr(digits, (5 * i + 1)::INT, 1)::INT + 8 * substr(digits, (5 * i + 2)::INT, 1)::INT + 4 * substr(digits, (5 * i + 3)::INT, 1)::INT
      + 2 * substr(digits, (5 * i + 4)::INT, 1)::INT + substr(digits, (5 * i + 5)::INT, 1)::INT)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM bits"""
