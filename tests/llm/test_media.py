import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from lakegauge.llm import media_chunks

SF = "/root/testdata/sf0.001"


def plain_cut(payload):
    """Chunk ends by the definition, byte by byte."""
    ends, last = [], 0
    for i in range(1, len(payload) + 1):
        size = i - last
        if i == len(payload):
            ends.append(i)
        elif size == media_chunks.MAX:
            ends.append(i)
            last = i
        elif size >= media_chunks.MIN:
            h = 0
            for b in payload[i - media_chunks.WINDOW : i]:
                h = ((h << 1) + int(media_chunks.GEAR[b])) & 0xFFFFFFFF
            if h >> (32 - media_chunks.BITS) == 0:
                ends.append(i)
                last = i
    return ends


def test_cuts_are_those_of_the_definition():
    rng = random.Random(1)
    texts = [rng.randbytes(n) for n in (64, 192, 5000, 30016)] + [b"\0" * 20000, b"ab" * 9000]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    assert media_chunks.cut(np.frombuffer(b"".join(texts), np.uint8), offsets) == [plain_cut(t) for t in texts]


def plain_form(chunks):
    """CDC1, the number of chunks, size and SHA-256 of each, and the chunks, by the definition."""
    listed = b"".join(len(c).to_bytes(4, "little") + hashlib.sha256(c).digest() for c in chunks)
    return b"CDC1" + len(chunks).to_bytes(4, "little") + listed + b"".join(chunks)


def plain_features(payload, chunks):
    """Numbers of a payload's samples, one by one."""
    n, mean = len(payload), sum(payload) / len(payload)
    shares = [k / n for k in Counter(payload).values()]
    turns = sum((a >= 128) != (b >= 128) for a, b in zip(payload, payload[1:]))
    return {"chunks": chunks, "mean": mean, "std": math.sqrt(sum((x - mean) ** 2 for x in payload) / n), "entropy": -sum(p * math.log2(p) for p in shares), "turns": turns}


def compare(spark, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, sha string")
    found = media_chunks.of_documents(docs).collect()
    assert len(found) == len(rows)
    want = sorted(((i is None, i or 0, t or "") for i, t in rows))
    for (_, i, t), r in zip(want, sorted(found, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["payload_sha256"]))):
        assert r["doc_id"] is None or r["doc_id"] == i
    by_sha = {r["payload_sha256"]: r for r in found}
    for _, t in rows:
        raw = (t or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 or (64 if not raw else 0))
        r = by_sha[hashlib.sha256(payload).hexdigest()]
        chunks = [payload[a:b] for a, b in zip([0, *plain_cut(payload)], plain_cut(payload))]
        form = plain_form(chunks)
        assert (r["payload_bytes"], r["tail_crc32"]) == (len(payload), zlib.crc32(payload[-64:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(form), hashlib.sha256(form).hexdigest())
        numbers = {k: float(v) for k, v in (x.split("=") for x in r["feature"].split(";"))}
        assert numbers == pytest.approx(plain_features(payload, len(chunks)), abs=2e-6)
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["payload_sha256"]) for r in found) == sorted((i or -1, len((t or "").encode()), hashlib.sha256((t or "").encode() + b"\0" * (-len((t or "").encode()) % 64 or (0 if t else 64))).hexdigest()) for i, t in rows)


def test_documents(spark):
    compare(spark, [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(120).collect()])


def test_odd_rows(spark):
    rng = random.Random(3)
    passage = "".join(chr(97 + rng.randrange(26)) for _ in range(6000))
    compare(spark, [(1, None), (2, ""), (3, "x" * 64), (4, passage), (5, "begin " + passage), (6, passage + passage), (4, passage), (4, "other"), (None, passage + "end"), (8, "é" * 40000), (9, "\0")])
    assert media_chunks.of_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_shared_chunks_are_stored_once(spark):
    rng = random.Random(4)
    passage = "".join(chr(97 + rng.randrange(26)) for _ in range(20000))
    docs = spark.createDataFrame([(i, f"{i} " * 50 + passage) for i in range(20)], "doc_id long, text string")
    _, _, store = media_chunks.write_media(docs)
    assert sum(len(r["data"]) for r in store.collect()) < 3 * 20000


def test_the_stored_form_is_what_the_files_hold(spark):
    rng = random.Random(5)
    passage = "".join(chr(97 + rng.randrange(26)) for _ in range(9000))
    rows = [(-(2**63), "a" + passage), (2**63 - 1, passage + "b"), (None, passage), (None, passage), (None, None), (7, "x" * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    work, _, _ = media_chunks.write_media(docs)
    stored = spark.read.parquet(f"{work.path}/store").collect()
    chunks = {bytes(r["key"]): bytes(r["data"]) for r in stored if r["kind"] == "chunk"}
    forms = {}
    for r in stored:
        if r["kind"] == "object":
            left, own = bytes(r["data"]), b""
            for size, digest in media_chunks.parse_head(bytes(r["head"])):
                part = chunks.get(digest, left[:size])
                left = left if digest in chunks else left[size:]
                own += part
            forms[hashlib.sha256(own).hexdigest()] = bytes(r["head"]) + own
    found = media_chunks.of_documents(docs).collect()
    assert len(forms) == 5 and len(found) == 6
    for r in found:
        form = forms[r["payload_sha256"]]
        assert (r["media_bytes"], r["media_sha256"]) == (len(form), hashlib.sha256(form).hexdigest())
    assert sorted((r["doc_id"] for r in found), key=str) == sorted((i for i, _ in rows), key=str)


def test_a_full_filter_moves_more_and_changes_nothing(spark, monkeypatch):
    rng = random.Random(8)
    passage = "".join(chr(97 + rng.randrange(26)) for _ in range(5000))
    docs = spark.createDataFrame([(i, f"{i} " * (i * 40) + (passage if i % 3 == 0 else "")) for i in range(40)] + [(50, "1 " * 40), (51, None)], "doc_id long, text string")
    wanted = sorted(map(tuple, media_chunks.of_documents(docs).collect()))
    whole = media_chunks._filter
    monkeypatch.setattr(media_chunks, "_filter", lambda keys: whole(keys) | np.uint32(0xFFFFFFFF))
    assert sorted(map(tuple, media_chunks.of_documents(docs).collect())) == wanted
