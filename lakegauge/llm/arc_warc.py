"""Legacy ARC archives to WARC, and WARC archives of pages.

An ARC record is a line of fields and then as many bytes as the line declares. Version 1 lines
have URL, IP, date, type and length; version 2 lines have URL, IP, date, type, result code,
checksum, location, offset, file name and length. The converter goes by the declared lengths alone
and makes for each record a WARC/1.1 record with target URI, IP address, date, type and length, a
record id from URL, date and payload digest, and digests of payload and block. Content that begins
with an HTTP response's head is a response whose payload comes after the head, other content a resource.

write_archives writes ARC files of the pages, reads them, and converts their records: of equal
payloads the one with the smallest page_id is a response, all others are revisits that keep the HTTP
head alone and refer to the response by record id, URI and date. A page's number is a field of the HTTP
head in ARC files, and a field of its own, WARC-Page-Id, in WARC records, so target URIs are the
pages' own. Archives are files of about file_bytes of content with a gzip member for each record,
written by Spark to the shared folder and read back as binary files. Pages have no time of their own;
DATE stands for it unless a column is named.

Defined results: null html is an empty payload; a null page_id comes after all others, and equal
payloads with null page_ids alone are all responses; rows that repeat the smallest page_id are
responses too; white space and unprintable characters of a URL are
percent-encoded, and a null or empty one is http://page.invalid/; extra columns are not written;
truncated or malformed ARC input raises.
"""

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext
from .workspace import Workspace, prepare

#: Content of an archive; a task holds some three times that.
FILE_BYTES = 16 << 20
DATE = "20260101000000"
_FIELDS = {1: ("url", "ip", "date", "type", "length"), 2: ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "file", "length")}
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the namespace of URLs
_PAGE = "X-Page-Id"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EMPTY_MEMBER = zlib.compressobj(1, zlib.DEFLATED, 31).flush()


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_header(version: int, name: str = "pages.arc") -> bytes:
    """The record that opens an ARC file; it tells the version of all others."""
    text = f"{version} 0 lakegauge\n{'URL IP-address Archive-date Content-type Archive-length' if version == 1 else 'URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length'}\n".encode()
    return arc_record(version, f"filedesc://{name}", text, "text/plain")


def arc_record(version: int, url: str, payload: bytes, kind: str = "text/html", ip: str = "0.0.0.0", date: str = DATE) -> bytes:
    middle = [] if version == 1 else ["200", "-", "-", "0", "pages.arc"]
    return " ".join([url, ip, date, kind, *middle, str(len(payload))]).encode() + b"\n" + payload + b"\n"


def parse_arc(data: bytes):
    """Fields (with version and payload) of each record of an ARC file, but for its opening record."""
    at, version = 0, 1
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError("an ARC record's line is cut short")
        line = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        opening = line[0].startswith("filedesc://")
        names = _FIELDS[2] if len(line) == 10 else _FIELDS[1]
        if len(line) != len(names) or not line[-1].isdigit() or (not opening and len(names) != len(_FIELDS[version])):
            raise ValueError(f"not a line of ARC version {version}: {line[:3]}")
        record = dict(zip(names, line))
        size = int(record["length"])
        payload = data[end + 1 : end + 1 + size]
        if len(payload) < size:
            raise ValueError("an ARC record is shorter than it declares")
        at = end + 1 + size
        if opening:
            version = 1 if payload[:1] == b"1" else 2
        else:
            yield record | {"version": version, "payload": payload}


def http_head(size: int, kind: str = "text/html; charset=utf-8", page: int | None = None) -> bytes:
    number = "" if page is None else f"{_PAGE}: {page}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\n{number}Content-Length: {size}\r\n\r\n".encode()


def page_of(head: bytes) -> int | None:
    """The page's number in an HTTP head."""
    found = re.search(rb"\r\n" + _PAGE.encode() + rb": (-?[0-9]+)\r\n", head)
    return int(found[1]) if found else None


def encoded(url: str | None) -> str:
    """The URL without white space and unprintable characters, which are percent-encoded."""
    return "".join(quote(c) if c.isspace() or not c.isprintable() else c for c in url) if url else "http://page.invalid/"


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """An HTTP response's head, empty if there is none, and what comes after it."""
    end = content.find(b"\r\n\r\n") + 4 if content.startswith(b"HTTP/") else 0
    return (content[:end], content[end:]) if end >= 4 else (b"", content)


def record_id(url: str, date: str, payload_digest: str, page: int | None = None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, ' '.join([url, date, payload_digest, *([] if page is None else [str(page)])]))}>"


def stamp(date: str) -> str:
    """An ARC date of 14 digits, or fewer, as WARC writes it."""
    full = date + "00000101000000"[len(date) :] if len(date) >= 4 else DATE
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def warc_record(fields: dict[str, str], block: bytes) -> bytes:
    fields = fields | {"WARC-Block-Digest": f"sha1:{digest(block)}", "Content-Length": str(len(block))}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n").encode() + block


def to_warc(record: dict, first: tuple[str, str, int] | None = None) -> bytes:
    """The WARC record of an ARC record, without the blank lines behind it; with first, URL, date and page of the response of the same payload, a revisit of that."""
    head, payload = split_http(record["payload"])
    own, page = digest(payload), page_of(head)
    fields = {
        "WARC-Type": "revisit" if first else "response" if head else "resource",
        "WARC-Record-ID": record_id(record["url"], record["date"], own, page),
        "WARC-Date": stamp(record["date"]),
        "WARC-Target-URI": record["url"],
        "WARC-IP-Address": record["ip"],
        "WARC-Payload-Digest": f"sha1:{own}",
    }
    if page is not None:
        fields["WARC-Page-Id"] = str(page)
    if first:
        fields |= {"WARC-Profile": _REVISIT, "WARC-Refers-To": record_id(first[0], first[1], own, first[2]), "WARC-Refers-To-Target-URI": first[0], "WARC-Refers-To-Date": stamp(first[1]), "WARC-Refers-To-Page-Id": str(first[2])}
    return warc_record(fields | {"Content-Type": "application/http; msgtype=response" if head else record["type"]}, head if first else record["payload"])


def parse_warc(data: bytes):
    """Fields and block of each record, by declared lengths."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
        at = end + 4
        block = data[at : at + int(fields["Content-Length"])]
        if len(block) < int(fields["Content-Length"]):
            raise ValueError("a WARC record is shorter than it declares")
        yield fields, block
        at += len(block)


def convert(archives: DataFrame, content: str = "content") -> DataFrame:
    """(version, url, record) for the records of ARC files given as binary rows; record is the WARC record."""

    def run(batches):
        for batch in batches:
            for data in batch.column(batch.schema.get_field_index(content)):
                rows = [(r["version"], r["url"], to_warc(r)) for r in parse_arc(data.as_buffer().to_pybytes() if data.is_valid else b"")]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.binary())], ["version", "url", "record"])

    prepare(archives.sparkSession)
    return archives.mapInArrow(run, "version int, url string, record binary")


def _files(rows: DataFrame, path: str) -> DataFrame:
    """Write each row of (data binary) as a file; an empty gzip member is the end that the text writer asks for."""
    options = {"lineSep": _EMPTY_MEMBER.decode("latin-1"), "encoding": "ISO-8859-1", "maxRecordsPerFile": "1"}
    rows.select(F.col("data").cast("string").alias("data")).write.options(**options).text(path)
    return rows.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def _member(data: bytes) -> bytes:
    press = zlib.compressobj(3, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def _whole(content) -> bytes:
    return gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())).read() if content.is_valid else b""


def write_arc(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """ARC files of (page_id, url, html, date), read back as binary rows; odd pages are of version 1."""

    def run(batches):
        for part in arrowtext.joined(batches, "html", file_bytes):
            for version in (1, 2):
                members = []
                for own, link, html, date in zip(*(part.column(i).to_pylist() for i in range(4))):
                    if ((own or 0) % 2 == 1) == (version == 1):
                        body = html.encode()
                        members.append(_member(arc_record(version, encoded(link), http_head(len(body), page=own) + body, date=date)))
                if members:
                    yield pa.RecordBatch.from_arrays([pa.array([_member(arc_header(version)) + b"".join(members)], pa.binary())], ["data"])

    return _files(pages.mapInArrow(run, "data binary"), path)


def arc_records(archives: DataFrame) -> DataFrame:
    """(page_id, url, ip, date, type, content, sha, size) of the records of ARC files; sha and size are the payload's."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for r in parse_arc(_whole(content)):
                    head, payload = split_http(r["payload"])
                    rows.append({"page_id": page_of(head), "url": r["url"], "ip": r["ip"], "date": r["date"], "type": r["type"], "content": r["payload"], "sha": hashlib.sha1(payload).digest(), "size": len(payload)})
                yield pa.RecordBatch.from_pylist(rows, _RECORDS)

    return archives.mapInArrow(run, "page_id long, url string, ip string, date string, type string, content binary, sha binary, size long")


_RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("type", pa.string()), ("content", pa.binary()), ("sha", pa.binary()), ("size", pa.int64())])


def write_archives(pages: DataFrame, work: Workspace, page_id: str = "page_id", url: str = "url", html: str = "html", date: str | None = None, file_bytes: int = FILE_BYTES) -> str:
    """Write the pages' ARC files and, converted, their WARC archives; returns the folder of these."""
    given = F.col(date).cast("string") if date else F.lit(DATE)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"), given.alias("date"))
    records = arc_records(write_arc(rows, f"{work.path}/arc", file_bytes))
    least = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url", "date")))
    first = records.groupBy("sha", "size").agg(least.alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    first = work.write(first.select("sha", "size", "first"), "first")
    # read from a table, so Spark may split a frequent payload
    marked = records.join(first, ["sha", "size"], "left")
    again = ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    marked = marked.select("url", "ip", "date", "type", "content", F.when(again, F.col("first.url")).alias("first_url"), F.when(again, F.col("first.date")).alias("first_date"), F.when(again, F.col("first.page_id")).alias("first_page"))

    def run(batches):
        for part in arrowtext.joined(batches, "content", file_bytes):
            out = [_member(warc_record({"WARC-Type": "warcinfo", "WARC-Date": stamp(DATE), "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(_SPACE, 'lakegauge')}>", "Content-Type": "application/warc-fields"}, b"software: lakegauge\r\n") + b"\r\n\r\n")]
            for url, ip, date, kind, content, first_url, first_date, first_page in zip(*(part.column(i).to_pylist() for i in range(8))):
                record = {"url": url, "ip": ip, "date": date, "type": kind, "payload": content}
                out.append(_member(to_warc(record, None if first_url is None else (first_url, first_date, first_page)) + b"\r\n\r\n"))
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], ["data"])

    _files(marked.mapInArrow(run, "data binary"), f"{work.path}/archives")
    return f"{work.path}/archives"


def read_archives(spark, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each record in the archives, checked."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in parse_warc(_whole(content)):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    own, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
                    head, payload = split_http(block)
                    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}" or not revisit and digest(payload) != own:
                        raise ValueError(f"the record of {fields['WARC-Target-URI']} has another digest than it says")
                    size = int(re.search(rb"\r\nContent-Length: ([0-9]+)\r\n", head)[1]) if revisit else len(payload)
                    number = lambda name: int(fields[name]) if name in fields else None  # noqa: B023, E731
                    rows.append({"page_id": number("WARC-Page-Id"), "payload_bytes": size, "payload_digest": own, "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To-Page-Id")})
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]))

    return files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
