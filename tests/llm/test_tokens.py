import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from lakegauge.llm import arrowtext, byte_bpe, pieces, queries, simple8b
from tokenizers import Tokenizer

RANKS = f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken"
JSON = f"{queries.TOKENIZERS}/byte_bpe_50k.json"
SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "a", "  two  spaces \n\n x", "don't you'll", "-----======aaaaaaaaaaaaa", "日本語 😀😀 é́", "\x1c\x1d\x85\xa0 x y", "<|endoftext|> tail", "²³ ½ ٣٤", "x" * 5000, "word " * 20000]


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "n", i) for i, t in enumerate(texts)], "doc_id long, text string, ids string, n_ids int")


def test_round_trip_equals_the_library(spark):
    want = library()
    docs = rows(spark, ODD + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]).drop("ids", "n_ids")
    found = byte_bpe.BytePairs(spark, RANKS, queries.PATTERN).round_trip(docs.withColumn("own", docs.text)).collect()
    assert len(found) == docs.count()
    for r in found:
        ids = want.encode_ordinary(r["own"] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["own"] or "").encode()).hexdigest()


def test_encode_offsets_and_decode(spark):
    pairs = byte_bpe.BytePairs(spark, RANKS, queries.PATTERN)
    docs = rows(spark, ODD).drop("ids", "n_ids")
    made = pairs.decode(pairs.encode(docs))
    for r in made.collect():
        text = r["text"] or ""
        assert r["decoded"] == text and len(r["ids"]) == len(r["char_start"]) == len(r["char_end"])
        if r["ids"]:
            assert r["char_start"][0] == 0 and r["char_end"][-1] == len(text)
        for i, a, b in zip(r["ids"], r["char_start"], r["char_end"]):
            assert 0 <= a < b <= len(text)
        if text.isascii():
            assert [text[a:b] for a, b in zip(r["char_start"], r["char_end"])] == [library_cached.decode([i]) for i in r["ids"]]
    assert pairs.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>")).collect() == [(None, None), ([], "")]
    assert pairs.round_trip(docs.limit(0)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80) | st.text("ab \n-'", max_size=60))
def test_merges_equal_ranks(text):
    want = library_cached.encode_ordinary(text)
    assert pieces.load_tokenizer(MODEL).encode(text, add_special_tokens=False).ids == want
    assert ranked.encode(pa.array([text]))[0].tolist() == want


MODEL = byte_bpe.model_json(byte_bpe.read_ranks(RANKS), queries.PATTERN)
library_cached = library()
ranked = pieces.PieceEncoder(MODEL)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 50256) | st.sampled_from([0, 1, 7, 2**60 - 1, 2**60]), max_size=1500) | st.integers(0, 3000).map(lambda n: [0] * n))
def test_simple8b_round_trip(values):
    values = np.array(values, np.uint64)
    words, groups, escapes = simple8b.encode(values)
    assert (simple8b.decode(words, escapes) == values).all()
    for i, at in enumerate(groups):
        stop = groups[i + 1] if i + 1 < len(groups) else len(words)
        assert (simple8b.decode(words[at:stop], escapes) == values[i * simple8b.GROUP : (i + 1) * simple8b.GROUP]).all()


def check_ids(spark, docs):
    tokenizer = Tokenizer.from_file(JSON)
    _, blocks = simple8b.write_ids(spark, docs, JSON, end=2)
    found = {(r["doc_id"], r["start"]): r for r in simple8b.read_ids(blocks, digest=True).collect()}
    plain = {(r["doc_id"], r["start"]): r["ids"] for r in simple8b.read_ids(blocks).collect()}
    start = 0
    wanted = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    assert len(found) == len(wanted)
    for r in wanted:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        row = found[r["doc_id"], start]
        assert row["n_tokens"] == len(ids) and plain[r["doc_id"], start] == ids
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_ids_of_documents(spark):
    check_ids(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_ids_of_odd_rows(spark):
    docs = rows(spark, ODD)
    check_ids(spark, docs)
    check_ids(spark, docs.unionAll(docs.limit(5)).unionAll(docs.limit(2).selectExpr("null", "text", "ids", "n_ids")))
    _, blocks = simple8b.write_ids(spark, docs.limit(0), JSON, end=2)
    assert simple8b.read_ids(blocks, digest=True).collect() == []


def test_pieces_of_every_character_below_u0250():
    tokenizer = Tokenizer.from_file(JSON)
    encoder = pieces.PieceEncoder(open(JSON, encoding="utf-8").read())
    for make in ("a{0}b", " {0} c", "{0}{0}9", "\n{0}x"):
        texts = [make.format(chr(c)) for c in range(1, 0x250)]
        ids, count = encoder.encode(pa.array(texts), 2)
        want = [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        stop = np.cumsum(count)
        assert [ids[a:b].tolist() for a, b in zip(stop - count, stop)] == want


plain = Tokenizer.from_file(JSON)
encoder = pieces.PieceEncoder(open(JSON, encoding="utf-8").read())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab 1\n\t'\xa0\x85strevlmdé.-", max_size=25) | st.text(max_size=20), max_size=6))
def test_pieces_equal_the_library(texts):
    ids, count = encoder.encode(pa.array(texts, pa.string()), 2)
    stop = np.cumsum(count)
    assert [ids[a:b].tolist() for a, b in zip(stop - count, stop)] == [plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def thue_morse(n):
    """A word of a and b and its complement: polynomials modulo a power of two take them for equal."""
    word = "".join("ab"[i.bit_count() & 1] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_long_words_of_two_letters_keep_their_own_ids(spark):
    texts = [t for n in (64, 1024, 2048, 4096) for t in thue_morse(n)]
    check_ids(spark, rows(spark, texts).coalesce(1))
    docs = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "doc_id long, text string, own string").coalesce(1)
    for r in byte_bpe.BytePairs(spark, RANKS, queries.PATTERN).round_trip(docs).collect():
        assert r["ids_sha256"] == hashlib.sha256(np.array(library_cached.encode_ordinary(r["own"]), "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["own"].encode()).hexdigest()


def test_pieces_that_share_a_hash_keep_their_own_ids(monkeypatch):
    made = arrowtext.span_hashes

    def few(data, start, end, lanes=1):
        found = made(data, start, end, lanes)
        return [found[0] & np.uint64(0xF0000000000000FF), *found[1:]]

    monkeypatch.setattr(arrowtext, "span_hashes", few)
    weak = pieces.PieceEncoder(open(JSON, encoding="utf-8").read(), 3000)
    for _ in range(3):
        texts = [f"word{i} and w{i % 7} of x{i * i}" for i in range(400)]
        ids, count = weak.encode(pa.array(texts))
        stop = np.cumsum(count)
        assert [ids[a:b].tolist() for a, b in zip(stop - count, stop)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_some_documents_are_read_from_their_groups_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    _, blocks = simple8b.write_ids(spark, docs, JSON, end=2)
    every = {r["doc_id"]: r["ids"] for r in simple8b.read_ids(blocks).collect()}
    some = sorted(every)[::7]
    assert {r["doc_id"]: r["ids"] for r in simple8b.read_documents(blocks, some).collect()} == {d: every[d] for d in some}
    assert simple8b.read_documents(blocks, []).collect() == []
    values = np.arange(3000, dtype=np.uint64) * np.uint64(7919)
    words, groups, escapes = simple8b.encode(values)
    for a, b in ((0, 0), (0, 1), (511, 513), (512, 1024), (5, 3000)):
        assert (simple8b.decode_range(words, groups, escapes, a, b) == values[a:b]).all()
