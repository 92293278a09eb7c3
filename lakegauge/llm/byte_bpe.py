"""Byte-level BPE over Arrow batches with the tokenizers library.

A rank file (base64 token and rank a line) becomes a tokenizers model: bytes are written as the
printable characters of byte_characters(), and every split of a token into two tokens is a merge
of that token's rank, so any neighbours whose join is a token merge by its rank.
Offsets come from the tokens' byte lengths: a token that begins or ends inside a character
counts that character whole. Decoding looks ids up in the byte table and joins bytes first, so
characters that tokens split come back whole.

Defined results: null text is empty and has no ids; ids that the table lacks raise; bytes that
are not UTF-8 decode to U+FFFD in decoded text; texts of any length are taken whole, one that is
longer than a slice in a slice of its own; an empty table gives an empty one; repeated rows and
extra columns are kept as they are, but for columns named as those made here.
"""

import base64
import hashlib
import json
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import arrowtext, workspace
from .pieces import PieceEncoder

#: Pieces that a worker remembers here, beside the merges' own table.
REMEMBERED = 500_000


def byte_characters() -> list[str]:
    """One printable character for each byte: itself where it prints, else one from U+0100 on in order."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in prints else next(spare)) for b in range(256)]


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return parse_ranks(file.read())


def model_json(ranks: dict[bytes, int], pattern: str) -> str:
    """A tokenizers file for these ranks and this pattern."""
    names = byte_characters()
    name = {token: "".join(map(names.__getitem__, token)) for token in ranks}
    merges = [
        [name[token[:i]], name[token[i:]]]
        for token in sorted(ranks, key=ranks.get)
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    split = {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False}
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [split, level]}, "post_processor": None, "decoder": level,
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False, "vocab": {name[t]: r for t, r in ranks.items()}, "merges": merges},
    })


class ByteTable:
    """The bytes of each id in one blob."""

    def __init__(self, tokens: dict[int, bytes]):
        n = max(tokens, default=-1) + 1
        self.size = np.full(n, -1, np.int64)
        self.size[list(tokens)] = [len(t) for t in tokens.values()]
        self.start = np.zeros(n, np.int64)
        ordered = [tokens.get(i, b"") for i in range(n)]
        self.start[1:] = np.cumsum([len(t) for t in ordered])[:-1]
        self.blob = np.frombuffer(b"".join(ordered), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The joined bytes of ids, and where each id ends in them."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or (self.size[ids] < 0).any()):
            raise ValueError("an id is not in the byte table")
        size = self.size[ids]
        end = np.cumsum(size)
        at = np.arange(end[-1] if len(end) else 0) + np.repeat(self.start[ids] - (end - size), size)
        return self.blob[at], end


def character_offsets(data: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one character of each token of one text, from its bytes and the tokens' byte ends."""
    begins = (data & 0xC0) != 0x80
    seen = np.concatenate([[0], np.cumsum(begins)])
    start = np.concatenate([[0], end[:-1]]) if len(end) else end
    inside = np.append(begins, True)[start] == 0
    return seen[start] - inside, seen[end]


@cache
def byte_table(content: bytes) -> ByteTable:
    return ByteTable({rank: token for token, rank in parse_ranks(content).items()})


@cache
def ranked_encoder(content: bytes, pattern: str) -> PieceEncoder:
    return PieceEncoder(model_json(parse_ranks(content), pattern), REMEMBERED)


class BytePairs:
    """encode, decode and round_trip over DataFrames, for one rank file and pattern.

    Tasks get the rank file's bytes and make the merges and the byte table once in each worker.
    """

    def __init__(self, spark, rank_file: str, pattern: str):
        workspace.prepare(spark)
        with open(rank_file, "rb") as file:
            self.ranks, self.pattern = spark.sparkContext.broadcast(file.read()), pattern  # of the vocabulary's size

    def encode(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """docs with ids, char_start and char_end (arrays of int, one entry a token)."""
        ranks, pattern = self.ranks, self.pattern
        docs = workspace.without(docs, "ids", "char_start", "char_end")
        schema = f"{workspace.ddl(docs)}, ids array<int>, char_start array<int>, char_end array<int>"

        def run(batches):
            pieces, table = ranked_encoder(ranks.value, pattern), byte_table(ranks.value)
            for part in arrowtext.slices(batches, text, 1 << 19):
                ids, count = pieces.encode(part.column(part.schema.get_field_index(text)))
                at = np.concatenate([[0], np.cumsum(count)])
                pairs = []
                for lo, hi in zip(at, at[1:]):
                    pairs.append(character_offsets(*table.decode(ids[lo:hi])))
                lists = [ids, *(np.concatenate([p[k] for p in pairs]) if pairs else ids for k in (0, 1))]
                arrays = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x.astype(np.int32))) for x in lists]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], [*part.schema.names, "ids", "char_start", "char_end"])

        return docs.mapInArrow(run, schema)

    def decode(self, docs: DataFrame, ids: str = "ids", to: str = "decoded") -> DataFrame:
        """docs with the text of an array column of ids; a null array is null."""
        ranks, docs = self.ranks, workspace.without(docs, to)

        def run(batches):
            table = byte_table(ranks.value)
            for batch in batches:
                texts = [None if x is None else table.decode(np.array(x, np.int64))[0].tobytes().decode("utf-8", "replace") for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, to])

        return docs.mapInArrow(run, f"{workspace.ddl(docs)}, `{to}` string")

    def round_trip(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """docs with n_tokens, ids_sha256 (ids as little-endian 32-bit) and decoded_sha256 (bytes made from the ids)."""
        ranks, pattern = self.ranks, self.pattern
        docs = workspace.without(docs, "n_tokens", "ids_sha256", "decoded_sha256")
        keep = [c for c in docs.columns if c != text]
        schema = ", ".join([*([workspace.ddl(docs.select(*keep))] if keep else []), "n_tokens long, ids_sha256 string, decoded_sha256 string"])

        def run(batches):
            pieces, table = ranked_encoder(ranks.value, pattern), byte_table(ranks.value)
            for part in arrowtext.slices(batches, text, 1 << 19):
                ids, count = pieces.encode(part.column(part.schema.get_field_index(text)))
                data, end = table.decode(ids)
                at = np.concatenate([[0], np.cumsum(count)])
                cut = np.concatenate([[0], end])[at]
                raw, little = memoryview(data.tobytes()), memoryview(ids.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in keep), pa.array(count),
                     pa.array([hashlib.sha256(little[4 * a : 4 * b]).hexdigest() for a, b in zip(at, at[1:])], pa.string()),
                     pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(cut, cut[1:])], pa.string())],
                    [*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

        return docs.mapInArrow(run, schema)
