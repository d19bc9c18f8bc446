"""Legacy web archives: ARC records to WARC files, and WARC files back to rows.

The converter reads an ARC record by its version's header line and declared length, and makes up
what WARC wants besides: record identifiers, dates, types and digests. Files are written by Spark's
text sink, whose row ending is the last line feed of a record, so any file system Spark knows will do.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm.common import shared_path

#: Namespace of the identifiers that are made up.
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:arc-record")
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class ArcRecord:
    """One record of an ARC file; what its version lacks is empty."""

    url: str
    ip: str
    date: str
    content_type: str
    body: bytes
    status: str = ""
    checksum: str = ""
    location: str = ""
    file_name: str = ""


_TAIL = {
    1: re.compile(r"^(?P<url>.*) (?P<ip>[0-9A-Fa-f.:]+) (?P<date>\d{8,14}) (?P<type>.*?) (?P<length>\d+)$", re.S),
    2: re.compile(r"^(?P<url>.*) (?P<ip>[0-9A-Fa-f.:]+) (?P<date>\d{8,14}) (?P<type>.*?) (?P<status>\d{1,3}|-) (?P<checksum>\S+) (?P<location>\S+) (?P<offset>\d+|-) (?P<file>\S+) (?P<length>\d+)$", re.S),
}


def arc_version_block(version: int, name: str, date: str) -> bytes:
    """The record that begins an ARC file and names its version."""
    fields = "URL IP-address Archive-date Content-type" + " Result-code Checksum Location Offset Filename" * (version == 2) + " Archive-length"
    body = f"{version} 0 archive\n{fields}\n".encode()
    tail = f" 200 - - 0 {name}" if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 {date} text/plain{tail} {len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, record: ArcRecord) -> bytes:
    """A record as an ARC file of this version holds it."""
    tail = f" {record.status or '-'} {record.checksum or '-'} {record.location or '-'} 0 {record.file_name or '-'}" if version == 2 else ""
    head = f"{record.url or '-'} {record.ip} {record.date} {record.content_type or 'no-type'}{tail} {len(record.body)}"
    return re.sub(r"[\r\n]", "%0A", head).encode() + b"\n" + record.body + b"\n"


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file. Its version block decides how header lines are read; without one both versions are tried.

    A body has the declared length, whatever it holds. Raises ValueError where header or length is wrong.
    """
    at, version = 0, 0
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        stop = data.find(b"\n", at)
        if stop < 0:
            raise ValueError(f"no header line at {at}")
        line = data[at:stop].decode("utf-8", "surrogateescape").rstrip("\r")
        opens = line.startswith("filedesc://")
        tries = (2, 1) if opens or not version else (version,)
        m = next((m for v in tries if (m := _TAIL[v].match(line))), None)
        if not m:
            raise ValueError(f"not an ARC header: {line[:100]!r}")
        length = int(m["length"])
        body = data[stop + 1 : stop + 1 + length]
        if len(body) < length:
            raise ValueError(f"{len(body)} of {length} bytes at {at}")
        at = stop + 1 + length
        if opens:
            number = body[:1]
            version = int(number) if number in (b"1", b"2") else 0
            if not version:
                raise ValueError("unknown ARC version")
            continue
        more = m.groupdict()
        skip = lambda k: "" if more.get(k) in (None, "-") else more[k]
        yield ArcRecord("" if m["url"] == "-" else m["url"], m["ip"], m["date"], m["type"], body, skip("status"), skip("checksum"), skip("location"), skip("file"))


def warc_date(date: str) -> str:
    """14 digits, or fewer as old crawlers wrote, as a WARC date. Missing parts are the least there are."""
    d = (date + "00000101000000"[len(date) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def payload_of(body: bytes) -> tuple[bool, int]:
    """Whether a body is an HTTP response, and where its payload begins."""
    if not body.startswith(b"HTTP/"):
        return False, 0
    ends = [(p + len(x)) for x in (b"\r\n\r\n", b"\n\n") if (p := body.find(x)) >= 0]
    return True, min(ends, default=len(body))


def warc_record(record: ArcRecord, key: str, revisit_of: str | None = None, extra: dict[str, str] | None = None) -> bytes:
    """The WARC record of an ARC record, without its last line feed.

    key: what the identifier is made from; revisit_of: the key of the record whose payload this one
    repeats. A revisit keeps the HTTP header as its block.
    """
    http, begin = payload_of(record.body)
    payload = memoryview(record.body)[begin:]
    kind = "revisit" if revisit_of is not None else "response" if http else "resource"
    block = record.body[:begin] if kind == "revisit" else record.body
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(SPACE, key)}>",
        f"WARC-Date: {warc_date(record.date)}",
        f"WARC-Target-URI: {record.url or 'urn:unknown'}",
        f"Content-Type: {'application/http; msgtype=response' if http else record.content_type}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if record.ip and record.ip != "0.0.0.0":
        lines.append(f"WARC-IP-Address: {record.ip}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(SPACE, revisit_of)}>"]
    lines += [f"{k}: {v}" for k, v in (extra or {}).items()]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(re.sub(r"[\r\n]", "%0A", x) for x in lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block + b"\r\n\r"


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, by declared lengths."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or stop < 0:
            raise ValueError(f"no WARC record at {at}")
        head = data[at:stop].decode("utf-8", "surrogateescape").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head)}
        length = int(fields["content-length"])
        block = data[stop + 4 : stop + 4 + length]
        if len(block) < length or data[stop + 4 + length : stop + 8 + length] != b"\r\n\r\n":
            raise ValueError(f"record at {at} isn't as long as declared")
        at = stop + 8 + length
        yield fields, block


def base32_of_hex(digest: Column) -> Column:
    """Base32 of 40 hex digits."""
    parts = []
    for group in range(8):
        value = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        parts += [F.substring(F.lit(BASE32), F.shiftright(value, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def write_archives(pages: DataFrame, path: str, version: int | None = None, crawled: str = "20000101000000", min_revisit_bytes: int = 0, records_per_file: int = 8192, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Renders each page as an ARC record of a version (None: of either, by its payload), converts it to WARC and writes archives of so many records at most.

    Of pages with equal payloads of at least min_revisit_bytes bytes that with the smallest id is the
    response (rows that repeat id and payload alike all are), the others revisit it; null ids come
    last. A null html is empty. The copies of one payload are a skewed join, which AQE splits; what
    is gathered for it is one row for each payload.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # sha1 is computed below as well, from rows without url: only copies need a partner.
    first = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    marked = rows.join(first, "digest", "left")
    revisits = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")) & (F.octet_length("payload") >= min_revisit_bytes)
    marked = marked.select("id", "url", "payload", F.when(revisits, F.col("first")).alias("first"))

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = b"software: arc converter\r\nformat: WARC File Format 1.1\r\n"
        started = False
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                out = []
                for row in batch.slice(i, 64).to_pylist():
                    if not started:
                        head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(SPACE, 'info')}>\r\nWARC-Date: {warc_date(crawled)}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
                        out.append(head.encode() + info + b"\r\n\r")
                        started = True
                    http = b"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
                    digest = sha1_base32(row["payload"])
                    arc = version or 1 + ord(digest[0]) % 2
                    old = arc_record(arc, ArcRecord(row["url"], "0.0.0.0", crawled, "text/html", http + row["payload"], "200"))
                    (record,) = read_arc(arc_version_block(arc, "pages.arc", crawled) + old)
                    extra = {} if row["id"] is None else {"X-Page-Id": str(row["id"])}
                    of = None
                    if row["first"] is not None:
                        extra["X-Refers-To-Page-Id"] = str(row["first"])
                        of = f"{row['first']} {digest}"
                    out.append(warc_record(record, f"{row['id']} {digest}", of, extra))
                yield pa.record_batch([pa.array(out, pa.binary())], names=["record"])

    records = marked.mapInArrow(convert, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for each page of the archives: what its record declares, checked against its block."""
    import zlib

    files = spark.read.format("binaryFile").load(path).select("content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(0)[i].as_py()
                data = zlib.decompress(data, 31) if data[:2] == b"\x1f\x8b" else data
                rows = []
                for fields, block in read_warc(data):
                    kind = fields["warc-type"]
                    if kind == "warcinfo":
                        continue
                    digest = fields["warc-payload-digest"].partition(":")[2]
                    size = int(fields["x-payload-length"])
                    if kind != "revisit":
                        begin = payload_of(block)[1]
                        if len(block) - begin != size or sha1_base32(memoryview(block)[begin:]) != digest:
                            raise ValueError("a payload differs from its digest")
                    page, of = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                    rows.append((page and int(page), size, digest, kind, of and int(of), fields["warc-record-id"], fields["warc-date"], fields["warc-target-uri"]))
                kinds = [pa.int64(), pa.int64(), *[pa.string()] * 2, pa.int64(), *[pa.string()] * 3]
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "warc_date", "target_uri"]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return files.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, warc_date string, target_uri string")


def warc_report(pages: DataFrame) -> DataFrame:
    """Writes the pages' archives to the shared folder and returns what they hold.

    An empty table makes no records and no rows. Repeated pages each have a record.
    """
    path = shared_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
