import base64
import gzip
import hashlib
import zlib

import duckdb
import pytest
from lakegauge.llm import arc_warc, queries
from lakegauge.llm.workspace import Workspace

SF = "/root/testdata/sf0.001"


def brute(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    for i, _, html in rows:
        own, text = first.get(html or ""), (html or "").encode()
        again = own is not None and i != own
        yield i, len(text), base64.b32encode(hashlib.sha1(text).digest()).decode(), "revisit" if again else "response", own if again else None


def compare(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("url", "url")
    found = arc_warc.read_archives(spark, arc_warc.write_archives(pages, Workspace(spark, "warc"))).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows), key=key)


def test_pages(spark):
    compare(spark, [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()])


def test_odd_pages(spark):
    body = "x\r\n\r\nWARC/1.1\r\n\r\nüñ😀\n\n"
    compare(spark, [(1, "http://a/", body), (2, None, body), (3, "http://b/ c", None), (4, "u", ""), (5, "u", "y" * 300000), (None, "u", body), (None, "u", "z"), (None, "u", "z"), (1, "http://a/", body), (9, "u\n", "\r\n\r\n"), (10, "u", "HTTP/1.1 200 OK\r\nX-Page-Id: 77\r\n\r\n"), (-4, "u", "n")])
    compare(spark, [])


def test_urls_are_the_pages_own():
    assert arc_warc.encoded("http://a/b c\n?q=ü%20") == "http://a/b%20c%0A?q=ü%20"
    assert arc_warc.encoded(None) == arc_warc.encoded("") == "http://page.invalid/"


def test_files_of_a_given_size(spark):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"{i} " * 5000) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    sizes = []
    for size in (1 << 15, 1 << 24):
        work = Workspace(spark, "warc")
        path = arc_warc.write_archives(pages, work, file_bytes=size)
        assert arc_warc.read_archives(spark, path).count() == 40
        sizes.append(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{work.path}/arc").count())
    assert sizes[1] == 2 < 10 < sizes[0]


def test_versions_and_lengths(spark):
    one = arc_warc.arc_header(1) + arc_warc.arc_record(1, "http://x/", b"a\n\nfiledesc://no 1 2 3 4\n", "text/plain", "1.2.3.4", "19990203040506")
    two = arc_warc.arc_header(2) + arc_warc.arc_record(2, "http://y/", b"") + arc_warc.arc_record(2, "http://z/", b"zz")
    rows = arc_warc.convert(spark.createDataFrame([(bytearray(one), 1), (bytearray(two), 2), (None, 3), (bytearray(), 4)], "content binary, record int")).collect()
    assert [(r["version"], r["url"]) for r in rows] == [(1, "http://x/"), (2, "http://y/"), (2, "http://z/")]
    fields, block = next(arc_warc.parse_warc(bytes(rows[0]["record"]) + b"\r\n\r\n"))
    assert block == b"a\n\nfiledesc://no 1 2 3 4\n" and fields["WARC-Date"] == "1999-02-03T04:05:06Z" and fields["WARC-IP-Address"] == "1.2.3.4"
    for bad in (one[:-20], b"http://x/ 1 2\n", b"no line", two.replace(b" 2\nzz", b" x\nzz")):
        with pytest.raises(ValueError):
            list(arc_warc.parse_arc(bad))


def test_archives_hold_a_member_for_each_record_and_revisits_refer(spark):
    rows = [(3, "http://a/x", "same"), (1, "http://b/", "same"), (2, "http://c/", "other"), (None, "http://d/", "same")]
    pages = spark.createDataFrame([(*r, "20200102030405") for r in rows], "page_id long, url string, html string, crawled string")
    work = Workspace(spark, "warc")
    path = arc_warc.write_archives(pages, work, date="crawled")
    arcs = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{work.path}/arc").collect()
    assert sum(len(list(arc_warc.parse_arc(gzip.decompress(bytes(r["content"]))))) for r in arcs) == 4
    found = {}
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect():
        data = bytes(r["content"])
        while data:
            one = zlib.decompressobj(31)
            text = one.decompress(data)
            data = one.unused_data
            for fields, block in arc_warc.parse_warc(text):
                assert text.startswith(b"WARC/1.1") and text.endswith(b"\r\n\r\n") and text.count(b"WARC/1.1") == 1
                if fields["WARC-Type"] != "warcinfo":
                    found[fields["WARC-Target-URI"]] = fields, block
    first, block = found["http://b/"]
    assert first["WARC-Type"] == "response" and block.endswith(b"\r\n\r\nsame") and first["WARC-Date"] == "2020-01-02T03:04:05Z"
    for name, page in (("http://a/x", "3"), ("http://d/", None)):
        fields, block = found[name]
        assert (fields["WARC-Type"], fields["WARC-Refers-To"], fields["WARC-Refers-To-Target-URI"], fields["WARC-Refers-To-Date"]) == ("revisit", first["WARC-Record-ID"], "http://b/", first["WARC-Date"])
        assert fields.get("WARC-Page-Id") == page and fields["WARC-Refers-To-Page-Id"] == "1"
        assert block.endswith(b"\r\n\r\n") and fields["WARC-Payload-Digest"] == first["WARC-Payload-Digest"]
    assert found["http://c/"][0]["WARC-Type"] == "response"


def test_query_equals_its_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = duckdb.sql(queries.oracle_sql()["op9_arc_to_warc"])
    assert sorted(map(str, (tuple(r) for r in queries.op9_arc_to_warc(spark, SF).select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))
