import gzip
import hashlib
import io

import pytest

from tessera.llm import warc
from tessera.llm.registry import QUERIES

from .conftest import SF, rows


def brute(pages):
    first = {}
    data = [(p, (h or "").encode()) for p, h in pages]
    for p, b in data:
        if p is not None and len(b) >= 100:
            first[b] = min(first.get(b, p), p)
    out = []
    for p, b in data:
        f = first.get(b)
        again = f is not None and p is not None and p > f
        out.append((-1 if p is None else p, len(b), hashlib.sha256(b).hexdigest(),
                    "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type,
                    r.refers_to) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    assert got(QUERIES["op5_warc"](spark, SF)) == brute([(r["page_id"], r["html"]) for r in rows("pages")])


def test_edges(spark):
    big = "<p>é\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\n\n</p>" * 5
    pages = [(1, "http://a/x y", big), (2, None, big), (3, "http://b/", None), (4, "http://c", ""), (5, "u", "x" * 99),
             (6, "u", "x" * 99), (7, "u", "y" * 100), (8, "v", "y" * 100), (9, "w", "\n" * 500), (10, "l", "z" * 300000),
             (8, "v", "y" * 100), (0, "w2", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as date", "'q' as value")
    assert got(warc.convert_pages(df)) == brute([(p, h) for p, _, h in pages])
    assert got(warc.convert_pages(df.limit(0))) == []
    lone = spark.createDataFrame([(None, None, big), (1, "x", big)], "page_id long, url string, html string")
    assert warc.convert_pages(lone).count() == 2


def test_round_trip_of_fields(spark):
    df = spark.createDataFrame([(7, "http://a.example/p?q=1", "hello")], "page_id long, url string, html string")
    r = warc.convert_pages(df).first()
    assert (r.url, r.date[:2], r.record_id[:10]) == ("http://a.example/p?q=1", "20", "<urn:uuid:") and len(r.record_id) == 47


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions_and_declared_lengths(version):
    extra = b"200 - - 0 f.arc " if version == 2 else b""
    block = f"{version} 0 Origin\n{warc.ARC_FIELDS[version]}\n".encode()
    body = b"HTTP/1.0 200 OK\r\n\r\nline\n\nfiledesc://no header\n"
    url = b"http://a/b c"
    data = (b"filedesc://f 0.0.0.0 20010101000000 text/plain " + extra + str(len(block)).encode() + b"\n" + block + b"\n"
            + url + b" 1.2.3.4 20010203040506 text/html " + extra + str(len(body)).encode() + b"\n" + body + b"\n"
            + b"http://cut 1.2.3.4 2001 text/html " + extra + b"50\nshort")
    a, b = warc.parse_arc(io.BytesIO(data))
    assert (a["url"], a["ip"], a["date"], a["block"], a["truncated"]) == (url.decode(), "1.2.3.4", "20010203040506", body, False)
    assert a["status"] == ("200" if version == 2 else None)
    assert b["block"] == b"short" and b["truncated"]


def test_archives_are_valid_gzip_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a", "x"), (2, "http://b", "y")], "page_id long, url string, html string").coalesce(1)
    warc.write_records(warc.arc_rows(df), f"file://{tmp_path}/arc", "\n")
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "arc").glob("*.gz"))
    assert raw.startswith(b"filedesc://") and [r["url"] for r in warc.parse_arc(io.BytesIO(raw))] == ["http://a", "http://b"]


def test_dates(spark):
    df = spark.createDataFrame([("20010203040506",), ("200102",), ("",), (None,), ("x2001y",)], "d string")
    assert [r.t for r in df.select(warc.iso_date(df.d).alias("t")).collect()] == [
        "2001-02-03T04:05:06Z", "2001-02-01T00:00:00Z", "1970-01-01T00:00:00Z", "1970-01-01T00:00:00Z",
        "2001-01-01T00:00:00Z"]


def test_copies_beside_null_ids(spark):
    """A record without an id takes no revisits from the records that have one."""
    big, other = "<p>the same payload</p>" * 9, "<p>another payload</p>" * 9
    pages = [(None, "u0", big), (1, "u1", big), (2, "u2", big), (None, "u3", big), (3, "u4", big), (None, "u5", other), (4, "u6", other),
             (None, "u7", "<p>only without ids</p>" * 9), (None, "u8", "<p>only without ids</p>" * 9)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert got(warc.convert_pages(df)) == brute([(p, h) for p, _, h in pages])
