"""Payloads in a store of content-defined chunks.

A payload is a text's UTF-8 bytes and then zeros up to a positive multiple of BLOCK, taken as 8-bit
samples. A gear hash of WINDOW bytes cuts it where BITS low bits are zero, at MIN bytes at least and
MAX at most, so equal passages give equal chunks. Chunk digests are deduplicated by Spark joins:
of equal payloads one object is stored, whatever rows have them; of a chunk that several places
have one copy is stored in a table by digest; all other chunks stay in their object's row.

The stored form of an object is its head (CDC1, the number of chunks, and the size and SHA-256 of
each in order) and the chunks behind it. The head is stored as those bytes; reading back takes head
and chunks from the files, follows the head's list, and verifies every chunk and the whole payload.
A payload that occurs once and shares no chunk is stored where its text is read. A Bloom filter of
fixed size names the others, and perhaps more; those move, compressed and one of each a task, to
where their marks are. Beyond the filter's size more payloads move, with the same result.

Defined results: null text is empty; equal texts have equal values; rows that repeat are stored
once and returned each; null ids are kept and need no more than others; extra columns are not
stored or returned.
"""

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext
from .workspace import Workspace

BLOCK = 64
WINDOW, BITS, MIN, MAX = 32, 10, 256, 8192
#: Bits of the filter that names payloads which share something.
FILTER_BITS = 1 << 26
GEAR = (arrowtext.keys(21, 256) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of the last WINDOW bytes' keys, each shifted by its age, by doubling."""
    total, width = GEAR[data], 1
    while width < WINDOW:
        total[width:] = total[width:] + (total[:-width] << np.uint32(width))
        width *= 2
    return total


def payloads(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The padded payloads in a row, and their offsets."""
    size = np.diff(offsets)
    padded = np.maximum(-(-size // BLOCK), 1) * BLOCK
    ends = np.concatenate([[0], np.cumsum(padded)])
    out = np.zeros(ends[-1], np.uint8)
    out[np.arange(len(data)) + np.repeat(ends[:-1] - offsets[:-1], size)] = data
    return out, ends


def cut(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """The chunk ends of each payload, counted from its start. Windows lie inside a chunk, as MIN > WINDOW."""
    # the lowest bits have seen few bytes; bits from 8 on have seen as many as their place
    hits = np.flatnonzero((gear(data) >> np.uint32(32 - BITS)) == 0) + 1
    at = np.searchsorted(hits, offsets)
    found = []
    for start, stop, lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), at[:-1].tolist(), at[1:].tolist()):
        own, last = [], start
        for hit in hits[lo : hi + 1].tolist() + [stop]:
            if hit > stop:
                hit = stop
            while hit - last > MAX:
                last += MAX
                own.append(last - start)
            if hit - last >= MIN and hit < stop:
                own.append(hit - start)
                last = hit
        if stop > last:
            own.append(stop - start)
        found.append(own)
    return found


def _pieces(data: np.ndarray, ends: np.ndarray):
    """Each payload and its chunks."""
    for start, stop, own in zip(ends[:-1], ends[1:], cut(data, ends)):
        payload = data[start:stop].tobytes()
        yield payload, [payload[a:b] for a, b in zip([0, *own], own)]


def index(docs: DataFrame) -> DataFrame:
    """(doc, n_bytes, sha, digests) of each row of (doc, text)."""

    def run(batches):
        for part in arrowtext.slices(batches, "text"):
            data, offsets = arrowtext.column(part.column(1))
            sha, digests = [], []
            for payload, chunks in _pieces(*payloads(data, offsets)):
                sha.append(hashlib.sha256(payload).digest())
                digests.append([hashlib.sha256(c).digest() for c in chunks])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets)), pa.array(sha, pa.binary()), pa.array(digests, pa.list_(pa.binary()))], ["doc", "n_bytes", "sha", "digests"])

    return docs.mapInArrow(run, "doc long, n_bytes long, sha binary, digests array<binary>")


def _bits(sha: np.ndarray) -> np.ndarray:
    """The filter's places for digests, rows of 32 bytes: three each."""
    return (np.ascontiguousarray(sha[:, :24]).view("<u8") % np.uint64(FILTER_BITS)).astype(np.int64)


def _filter(keys: DataFrame) -> np.ndarray:
    """The bytes of a Bloom filter of the digests in keys."""

    def run(batches):
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, 32)
            yield pa.RecordBatch.from_arrays([pa.array(_bits(raw).ravel())], ["bit"])

    words = keys.mapInArrow(run, "bit long").groupBy(F.shiftright("bit", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 31 AS INT))")).alias("bits"))
    found = words.toArrow()  # a row for each 32 bits of the filter at most
    out = np.zeros(FILTER_BITS // 32, "<u4")
    out[found.column(0).to_numpy()] = found.column(1).to_numpy().astype("<u4")
    return out


def _first_pass(docs: DataFrame, moving: np.ndarray) -> DataFrame:
    """Objects of the rows of (doc, text) that the filter does not hold, and the others' payloads, compressed, as moved."""
    held = docs.sparkSession.sparkContext.broadcast(moving)  # FILTER_BITS

    def run(batches):
        import zstandard

        press = zstandard.ZstdCompressor(level=6)
        for part in arrowtext.slices(batches, "text"):
            data, ends = payloads(*arrowtext.column(part.column(1)))
            shas = [hashlib.sha256(data[a:b]).digest() for a, b in zip(ends, ends[1:])]
            bit = _bits(np.frombuffer(b"".join(shas), np.uint8).reshape(-1, 32))
            move = ((held.value[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1).all(axis=1)
            rows = []
            for sha, away, (payload, chunks) in zip(shas, move.tolist(), _pieces(data, ends)):
                if away:
                    rows.append({"kind": "moved", "key": sha, "data": press.compress(payload)})
                else:
                    rows.append({"kind": "object", "key": sha, "head": head(chunks, [hashlib.sha256(c).digest() for c in chunks]), "shared": [], "data": payload})
            yield pa.RecordBatch.from_pylist(rows, _STORE)

    return docs.mapInArrow(run, _STORE_DDL)


def head(chunks: list[bytes], digests: list[bytes]) -> bytes:
    """What precedes the chunks in the stored form."""
    return b"CDC1" + struct.pack("<I", len(chunks)) + b"".join(struct.pack("<I", len(c)) + d for c, d in zip(chunks, digests))


def media(sha: bytes, chunks: list[bytes]) -> bytes:
    """The stored form of a payload that is cut into these chunks."""
    return head(chunks, [hashlib.sha256(c).digest() for c in chunks]) + b"".join(chunks)


def parse_head(data: bytes) -> list[tuple[int, bytes]]:
    """Size and digest of each chunk, in order."""
    count = int.from_bytes(data[4:8], "little")
    if data[:4] != b"CDC1" or len(data) != 8 + 36 * count:
        raise ValueError("not the head of a stored payload")
    return [(int.from_bytes(data[at : at + 4], "little"), data[at + 4 : at + 36]) for at in range(8, len(data), 36)]


def _store(objects: DataFrame) -> DataFrame:
    """Rows of objects and of shared chunks, from (sha, packed, shared: array of (seq, here))."""

    def run(batches):
        import zstandard

        press = zstandard.ZstdDecompressor()
        for part in arrowtext.slices(batches, "packed"):
            raw = [press.decompress(x.as_py()) for x in part.column(1)]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
            rows = []
            for sha, own, (_, chunks) in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), _pieces(np.frombuffer(b"".join(raw), np.uint8), ends)):
                shared = {s["seq"]: s["here"] for s in own or ()}
                digests = [hashlib.sha256(c).digest() for c in chunks]
                rows.append({"kind": "object", "key": sha, "head": head(chunks, digests), "shared": sorted({digests[s] for s in shared}), "data": b"".join(c for i, c in enumerate(chunks) if i not in shared)})
                rows += [{"kind": "chunk", "key": digests[s], "data": chunks[s]} for s, here in shared.items() if here]
            yield pa.RecordBatch.from_pylist(rows, _STORE)

    return objects.mapInArrow(run, _STORE_DDL)


_STORE_DDL = "kind string, key binary, head binary, shared array<binary>, data binary"
_STORE = pa.schema([("kind", pa.string()), ("key", pa.binary()), ("head", pa.binary()), ("shared", pa.list_(pa.binary())), ("data", pa.binary())])


def write_media(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[Workspace, DataFrame, DataFrame]:
    """Store the payloads of docs; returns the folder, the index of all rows and the store."""
    work = Workspace(docs.sparkSession, "media")
    named = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    rows = work.write(index(named), "index")
    places = rows.groupBy("sha").agg(F.first("digests").alias("digests")).select("sha", F.posexplode("digests").alias("seq", "digest"))
    # 16 bytes of a digest tell chunks and objects apart; stored lists have all 32
    places = places.select(F.substring("digest", 1, 16).alias("digest"), F.substring("sha", 1, 16).alias("object"), "seq", "sha")
    place = F.struct("object", "seq")
    shared = work.write(places.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select("digest", "first"), "shared")
    marked = places.join(shared, "digest").select("sha", F.struct("seq", (place == F.col("first")).alias("here")).alias("mark"))
    marks = work.write(marked.groupBy("sha").agg(F.collect_list("mark").alias("shared")), "marks")
    twice = rows.groupBy("sha").agg(F.count("*").alias("n")).where("n > 1")
    stored = _first_pass(named, _filter(twice.select("sha").union(marks.select("sha"))))
    options = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}
    stored.write.partitionBy("kind").options(**options).parquet(f"{work.path}/store")
    store = work.read("store", stored.schema)
    # one payload of each digest leaves a task, so copies do not meet in one
    moved = store.where("kind = 'moved'").groupBy(F.col("key").alias("sha")).agg(F.first("data").alias("packed"))
    rest = _store(moved.join(marks, "sha", "left").select("sha", "packed", "shared"))
    rest.write.mode("append").partitionBy("kind").options(**options).parquet(f"{work.path}/store")
    return work, rows.select("doc", "n_bytes", "sha"), work.read("store", stored.schema).where("kind <> 'moved'")


def features(payload: bytes, chunks: int) -> str:
    """Mean, spread, entropy and sign changes of the samples."""
    samples = np.frombuffer(payload, np.uint8)
    share = np.bincount(samples, minlength=256) / len(samples)
    bits = -float((share[share > 0] * np.log2(share[share > 0])).sum())
    level = samples.astype(np.int16) - 128
    turns = int(((level[1:] >= 0) != (level[:-1] >= 0)).sum())
    return f"chunks={chunks};mean={samples.mean():.6f};std={samples.std():.6f};entropy={bits:.6f};turns={turns}"


def read_media(work: Workspace, store: DataFrame) -> DataFrame:
    """(sha, payload_bytes, tail_crc32, media_bytes, media_sha, feature) of each stored object; sha is that of the payload read."""
    objects = store.where("kind = 'object'").select("key", "head", "shared", "data")
    chunks = store.where("kind = 'chunk'").select(F.col("key").alias("digest"), F.col("data").alias("bytes"))
    wanted = objects.where(F.size("shared") > 0).select("key", F.explode("shared").alias("digest"))
    parts = wanted.join(chunks, "digest").groupBy("key").agg(F.collect_list(F.struct("digest", "bytes")).alias("parts"))
    none = F.lit(None).cast("array<struct<digest:binary,bytes:binary>>")
    mixed = objects.where(F.size("shared") > 0).join(parts, "key").select("key", "head", "data", "parts")
    whole = objects.where(F.size("shared") == 0).select("key", "head", "data", none.alias("parts")).unionByName(mixed)

    def run(batches):
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                sha, front, data, parts = (batch.column(k)[i].as_py() for k in range(4))
                given = {p["digest"]: p["bytes"] for p in parts or ()}
                at, ordered = 0, []
                for size, digest in parse_head(front):
                    chunk = given.get(digest)
                    if chunk is None:
                        chunk = data[at : at + size]
                        at += size
                    if len(chunk) != size or hashlib.sha256(chunk).digest() != digest:
                        raise ValueError("a stored chunk is not what its list says")
                    ordered.append(chunk)
                payload = b"".join(ordered)
                if hashlib.sha256(payload).digest() != sha or at != len(data):
                    raise ValueError("stored chunks do not make the payload")
                form = hashlib.sha256(front)
                form.update(payload)
                rows.append({"sha": sha, "payload_bytes": len(payload), "tail_crc32": zlib.crc32(payload[-BLOCK:]), "media_bytes": len(front) + len(payload), "media_sha": form.digest(), "feature": features(payload, len(ordered))})
            yield pa.RecordBatch.from_pylist(rows, _FEATURES)

    found = whole.mapInArrow(run, "sha binary, payload_bytes long, tail_crc32 long, media_bytes long, media_sha binary, feature string")
    return work.write(found, "features")


_FEATURES = pa.schema([("sha", pa.binary()), ("payload_bytes", pa.int64()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha", pa.binary()), ("feature", pa.string())])


def of_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row of what is read back for each row of docs."""
    work, rows, store = write_media(docs, doc_id, text)
    found = rows.join(read_media(work, store), "sha")
    return found.select(F.col("doc").alias("doc_id"), "n_bytes", "payload_bytes", F.lower(F.hex("sha")).alias("payload_sha256"), "tail_crc32", "media_bytes", F.lower(F.hex("media_sha")).alias("media_sha256"), "feature")
