r"""Legacy archive converter: ARC files to WARC.

An ARC file starts with a version block (``filedesc://``) that names the version
and the fields of its record headers: version 1 has URL, IP address, date, content type and length, version 2
adds result code, checksum, location, offset and file name. Every record is a header line, then as many bytes as the
declared length, then a newline. :func:`read_arc` parses archives by these
declared lengths (payloads may hold any bytes), whichever version each file is of.
:func:`convert` synthesises what WARC needs: record ids (name-based UUIDs of URL,
date and digest), ISO timestamps, types, digests, and revisit records for payloads seen before.

Archives are written by Spark's text writer, one record per row, with the record
terminator of the format as line separator; so writing needs no local files and works on any
storage that Spark can write. One partition becomes one gzip archive.

Cases: null html is an empty payload, a null URL is written as ``unknown:``, white space in
URLs is percent-encoded, null ids come back as null. Short or malformed dates are
padded. A record cut off by the end of a file is kept with what is there and marked. Empty tables
give no records. Of equal payloads (100 bytes or more) all records with the smallest page_id are responses, and so are those without a page_id, to which no
record refers. Other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.components import written
from tessera.session import shared_dir

REVISIT_LEAST = 100
PIECE_BYTES = 4 << 20
# fixed field names of the two versions, and the profile of revisit records
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


# -- writing the legacy archives ---------------------------------------------

def arc_rows(pages: DataFrame) -> DataFrame:
    """One string per page: its ARC record; a partition's first row also holds the
    version block. Partitions alternate between versions 1 and 2. The tables have no fetch
    data, so address and date are derived from the page's id and URL."""
    body = F.coalesce(F.col("html"), F.lit(""))
    url = F.regexp_replace(F.regexp_replace(F.coalesce(F.col("url"), F.lit("unknown:")), " ", "%20"), r"\s", "%09")
    key = F.conv(F.substring(F.md5(url), 1, 6), 16, 10).cast("long")
    address = F.concat_ws(".", F.lit("10"), *[(F.shiftright(key, n) % 256).cast("string") for n in (16, 8, 0)])
    when = F.date_format(F.timestamp_seconds(
        F.lit(1672531200) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)) * 86_413, F.lit(63_072_000))), "yyyyMMddHHmmss")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: "),
                    F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n\r\n"))
    length = (F.octet_length(head) + F.octet_length(body)).cast("string")
    two = F.spark_partition_id() % 2 == 1
    name = F.concat(F.lit("pages-"), F.spark_partition_id().cast("string"), F.lit(".arc.gz"))
    middle = F.when(two, F.concat_ws(" ", F.lit("200"), F.md5(body), F.lit("-"), F.lit("0"), name, length)).otherwise(length)
    record = F.concat(F.concat_ws(" ", url, address, when, F.lit("text/html"), middle), F.lit("\n"), head, body)

    def block(version: int) -> Column:
        text = f"{version} 0 Origin\n{ARC_FIELDS[version]}\n"
        extra = F.concat(F.lit("200 - - 0 "), name, F.lit(" ")) if version == 2 else F.lit("")
        return F.concat(F.lit("filedesc://"), name, F.lit(" 0.0.0.0 20230101000000 text/plain "), extra,
                        F.lit(f"{len(text)}\n{text}\n"))

    first = F.monotonically_increasing_id() % (1 << 33) == 0
    intro = F.when(first, F.when(two, block(2)).otherwise(block(1))).otherwise(F.lit(""))
    return pages.select(F.concat(intro, record).alias("value"))


def write_records(rows: DataFrame, path: str, terminator: str) -> None:
    rows.write.option("lineSep", terminator).option("compression", "gzip").text(path)


# -- parsing -----------------------------------------------------------------

def parse_arc(stream: io.BufferedIOBase) -> Iterator[dict]:
    """Records of an ARC stream: url, ip, date, mime, status, block, truncated."""
    names: list[bytes] = []
    while line := stream.readline():
        line = line.rstrip(b"\r\n")
        if not line:
            continue
        if line.startswith(b"filedesc://"):
            block = stream.read(int(line.rsplit(b" ", 1)[1]))
            names = block.split(b"\n")[1].split()
            continue
        if not names:
            raise ValueError("the archive has no version block")
        # the URL may hold spaces in old archives; all other fields may not
        fields = line.rsplit(b" ", len(names) - 1)
        if len(fields) != len(names):
            raise ValueError(f"header of {len(fields)} fields, {len(names)} declared")
        head = dict(zip((n.lower() for n in names), fields))
        size = int(head[b"archive-length"])
        block = stream.read(size)
        yield {"url": head[b"url"].decode(errors="replace"), "ip": head[b"ip-address"].decode(),
               "date": head[b"archive-date"].decode(), "mime": head[b"content-type"].decode(errors="replace"),
               "status": head.get(b"result-code", b"").decode() or None, "block": block, "truncated": len(block) < size}


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record of a WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not at the start of a record")
        head: dict[str, str] = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            head[name.decode().lower()] = value.strip().decode(errors="replace")
        yield head, stream.read(int(head["content-length"]))


def split_http(block: bytes) -> tuple[bytes, bytes]:
    head, mark, payload = block.partition(b"\r\n\r\n")
    return head + mark, payload


def http_field(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?mi)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode() if m else None


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")


def _stream(content: pa.Scalar) -> gzip.GzipFile:
    return gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= PIECE_BYTES or len(held) >= 10_000:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)


def read_arc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """(page_id, url, ip, date, mime, status, truncated, http_head, payload_bytes, payload_digest[, payload])."""
    names = [("page_id", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()),
             ("mime", pa.string()), ("status", pa.string()), ("truncated", pa.bool_()), ("http_head", pa.string()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    schema = pa.schema(names + ([("payload", pa.binary())] if payload else []))

    def rows(batches):
        for batch in batches:
            for content in batch.column(0):
                for r in parse_arc(_stream(content)):
                    head, body = split_http(r["block"])
                    page = http_field(head, "X-Page-Id")
                    row = (int(page) if page else None, r["url"], r["ip"], r["date"], r["mime"], r["status"],
                           r["truncated"], head.decode(errors="replace"), len(body), hashlib.sha256(body).hexdigest())
                    yield row + ((body,) if payload else ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rows(batches), schema, lambda r: r[8] if payload else 0)

    ddl = ("page_id long, url string, ip string, date string, mime string, status string, truncated boolean, "
           "http_head string, payload_bytes long, payload_digest string" + (", payload binary" if payload else ""))
    return _archives(spark, path).mapInArrow(run, ddl)


# -- conversion --------------------------------------------------------------

def record_id(url: Column, date: Column, digest: Column) -> Column:
    """Name-based UUID of a record, as a URN."""
    h = F.sha2(F.concat_ws("|", url, date, digest), 256)
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
             F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def iso_date(date: Column) -> Column:
    """ISO 8601 time of an ARC date of up to 14 digits (missing parts are the lowest)."""
    d = F.regexp_replace(F.coalesce(date, F.lit("")), "[^0-9]", "")
    d = F.concat(d, F.substr(F.lit("19700101000000"), F.length(d) + 1))
    part = lambda a, n: F.substring(d, a, n)
    return F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit("T"), part(9, 2), F.lit(":"),
                    part(11, 2), F.lit(":"), part(13, 2), F.lit("Z"))


def revisits(meta: DataFrame, least: int = REVISIT_LEAST) -> DataFrame:
    """(page_id, payload_digest, refers_to, refers_id, refers_uri) of the records that repeat an earlier payload."""
    long = meta.where((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull())
    own = F.struct("page_id", "url", "date")
    firsts = long.groupBy("payload_digest").agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = firsts.select("payload_digest", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_uri"),
                           record_id(F.col("first.url"), F.col("first.date"), F.col("payload_digest")).alias("refers_id"))
    return (long.join(firsts, "payload_digest").where("page_id > refers_to")
                .select("page_id", "payload_digest", "refers_to", "refers_id", "refers_uri").distinct())


def convert(records: DataFrame, again: DataFrame) -> DataFrame:
    """One string per record: the WARC record without its terminator; a partition's first row also holds a warcinfo record."""
    r = records.join(again, ["page_id", "payload_digest"], "left")
    repeat = F.col("refers_to").isNotNull()
    kind = F.when(repeat, "revisit").otherwise("response")
    body = F.when(repeat, F.lit("")).otherwise(F.col("payload").cast("string"))
    block = F.concat("http_head", body)

    def field(name: str, value: Column, on: Column | None = None) -> Column:
        line = F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
        return line if on is None else F.when(on, line).otherwise(F.lit(""))

    head = F.concat(
        F.lit("WARC/1.0\r\n"), field("WARC-Type", kind),
        field("WARC-Record-ID", record_id(F.col("url"), F.col("date"), F.col("payload_digest"))),
        field("WARC-Date", iso_date(F.col("date"))), field("WARC-Target-URI", F.col("url")),
        field("WARC-IP-Address", F.col("ip")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        field("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(block, 256))),
        field("WARC-Truncated", F.lit("unspecified"), F.col("truncated")),
        field("WARC-Profile", F.lit(REVISIT_PROFILE), repeat),
        field("WARC-Refers-To", F.coalesce("refers_id", F.lit("")), repeat),
        field("WARC-Refers-To-Target-URI", F.coalesce("refers_uri", F.lit("")), repeat),
        field("X-Refers-To-Page", F.coalesce(F.col("refers_to").cast("string"), F.lit("")), repeat),
        field("X-Payload-Length", F.col("payload_bytes").cast("string"), repeat),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        field("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    about = "software: legacy archive converter\r\nformat: WARC File Format 1.0\r\n"
    info = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Date: 2023-01-01T00:00:00Z\r\n"),
        field("WARC-Record-ID", record_id(F.lit("warcinfo"), F.spark_partition_id().cast("string"), F.lit(""))),
        F.lit(f"Content-Type: application/warc-fields\r\nContent-Length: {len(about)}\r\n\r\n{about}\r\n\r\n"))
    first = F.monotonically_increasing_id() % (1 << 33) == 0
    return r.select(F.concat(F.when(first, info).otherwise(F.lit("")), head, block).alias("value"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, date, record_id) of responses and
    revisits; a response whose payload differs from its declared digest is an error."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                        ("date", pa.string()), ("record_id", pa.string())])

    def rows(batches):
        for batch in batches:
            for content in batch.column(0):
                for head, block in parse_warc(_stream(content)):
                    kind = head["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    http, payload = split_http(block)
                    page = http_field(http, "X-Page-Id")
                    digest = head["warc-payload-digest"].partition(":")[2]
                    if kind == "response":
                        size, refers = len(payload), None
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"payload of {head['warc-record-id']} differs from its digest")
                    else:
                        size, refers = int(head["x-payload-length"]), int(head["x-refers-to-page"])
                    yield (int(page) if page else None, size, digest, kind, refers, head["warc-target-uri"],
                           head["warc-date"], head["warc-record-id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rows(batches), schema, lambda r: 0)

    return _archives(spark, path).mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
             "url string, date string, record_id string")


def convert_pages(pages: DataFrame) -> DataFrame:
    """Write pages as ARC archives, convert these to WARC archives, and read those back."""
    spark = pages.sparkSession
    arc, warc = shared_dir(spark, "arc"), shared_dir(spark, "warc")
    write_records(arc_rows(pages.select("page_id", "url", "html")), arc, "\n")
    again = written(revisits(read_arc(spark, arc, payload=False)), "revisits")
    write_records(convert(read_arc(spark, arc), again), warc, "\r\n\r\n")
    return read_warc(spark, warc)
