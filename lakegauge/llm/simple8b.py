"""Token ids as Simple-8b words in ordered shards.

A 64-bit word has a selector in its top four bits and that selector's count of ids of equal width
in the rest. Selector 15 points to a value of over 60 bits in the block's list of escapes.
A block holds whole documents; groups of GROUP ids start on a word of their own, and the block
keeps the word at which each group starts, so that any group decodes alone and all decode at once.

Layout: Parquet rows (shard, block, ids_before, doc_ids, doc_ends, words, group_words, escapes),
one file or more a shard; shards, blocks in a shard and documents in a block ascend by doc_id
(null first; equal doc_ids by text, and null is empty). Extra columns are not written.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrowtext, workspace
from .pieces import encoder

#: Ids in a word and bits of each, by selector.
COUNT = np.array([240, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
WIDTH = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60])
ESCAPE = 15
GROUP = 512
BLOCK_IDS = 1 << 18
U = np.uint64


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs; 0 for 0."""
    high = (values >> U(32)).astype(np.float64)
    low = (values & U(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1]).astype(np.int16)


#: For a run of k ids of at most w bits, the widest width that k ids in one word may have.
_FIT = {int(n): int(w) for n, w in zip(COUNT[:15], WIDTH[:15])}


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the word at which each group of GROUP values starts, and escapes.

    All groups advance together, a word of each at a time, so steps number the words of one group.
    """
    values = np.ascontiguousarray(values, U)
    n = len(values)
    if not n:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, U)
    bits = _bits(values)
    padded = np.concatenate([bits, np.full(240, 99, np.int16)])
    groups = -(-n // GROUP)
    at = np.arange(groups) * GROUP
    stop = np.minimum(at + GROUP, n)
    group = np.arange(groups)
    lanes = np.arange(15)
    place, used, chosen = [], [], []
    while len(at):
        left = stop - at
        top = np.maximum.accumulate(padded[at[:, None] + lanes], axis=1)
        selector = np.full(len(at), 14)
        for s in range(13, 3, -1):  # the last that fits holds most ids
            k = COUNT[s]
            selector[(top[:, k - 1] <= WIDTH[s]) & (left >= k)] = s
        if (wide := np.flatnonzero((top[:, 14] <= 3) & (left >= 20))).size:
            for s in (3, 2, 1, 0):
                k = COUNT[s]
                if (rows := wide[left[wide] >= k]).size:
                    fits = padded[at[rows][:, None] + np.arange(k)].max(axis=1) <= WIDTH[s]
                    selector[rows[fits]] = s
        selector[padded[at] > 60] = ESCAPE
        place.append(at), used.append(group), chosen.append(selector)
        at = at + COUNT[selector]
        if not (more := at < stop).all():
            at, stop, group = at[more], stop[more], group[more]
    place, used, chosen = map(np.concatenate, (place, used, chosen))
    order = np.argsort(place)
    place, used, chosen = place[order], used[order], chosen[order]
    words = chosen.astype(U) << U(60)
    for s in range(1, 15):
        if (rows := np.flatnonzero(chosen == s)).size:
            taken = values[place[rows][:, None] + np.arange(COUNT[s])]
            words[rows] |= np.bitwise_or.reduce(taken << (np.arange(COUNT[s]) * WIDTH[s]).astype(U), axis=1)
    rows = np.flatnonzero(chosen == ESCAPE)
    words[rows] |= np.arange(len(rows)).astype(U)
    return words, np.searchsorted(used, np.arange(groups)), values[place[rows]]


def decode(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """All values of a run of words."""
    words = np.asarray(words, U)
    selector = (words >> U(60)).astype(np.int64)
    count = COUNT[selector]
    start = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), U)
    for s in range(1, 15):
        if (rows := np.flatnonzero(selector == s)).size:
            lane = np.arange(COUNT[s])
            out[start[rows][:, None] + lane] = (words[rows][:, None] >> (lane * WIDTH[s]).astype(U)) & U((1 << int(WIDTH[s])) - 1)
    rows = np.flatnonzero(selector == ESCAPE)
    out[start[rows]] = np.asarray(escapes, U)[(words[rows] & U((1 << 60) - 1)).astype(np.int64)]
    return out


def decode_range(words: np.ndarray, group_words: np.ndarray, escapes: np.ndarray, first: int, last: int) -> np.ndarray:
    """Values first to last - 1 of a block, from the words of the groups that hold them alone."""
    if last <= first:
        return np.zeros(0, U)
    group, beyond = first // GROUP, -(-last // GROUP)
    stop = group_words[beyond] if beyond < len(group_words) else len(words)
    own = decode(words[group_words[group] : stop], escapes)
    return own[first - group * GROUP : last - group * GROUP]


BLOCKS = "shard int, block long, ids_before long, doc_ids array<long>, doc_ends array<long>, words binary, group_words array<long>, escapes array<decimal(20,0)>, n_ids long"


def write_ids(spark: SparkSession, docs: DataFrame, model_file: str, end: int, doc_id: str = "doc_id", text: str = "text") -> tuple[workspace.Workspace, DataFrame]:
    """Encode docs and write their ids; returns the folder and its blocks."""
    work = workspace.Workspace(spark, "simple8b")
    with open(model_file, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())  # of the vocabulary's size

    def run(batches):
        from pyspark import TaskContext

        shard, block, before = TaskContext.get().partitionId(), 0, 0
        pieces = encoder(model.value)
        for part in arrowtext.slices(batches, text, 1 << 20):
            column = part.column(part.schema.get_field_index(text))
            ids, count = pieces.encode(column, end)
            names = part.column(part.schema.get_field_index(doc_id)).to_pylist()
            stop = np.cumsum(count)
            cuts = [0, *(np.flatnonzero(np.diff((stop - count) // BLOCK_IDS)) + 1).tolist(), len(names)]
            rows = []
            for lo, hi in zip(cuts, cuts[1:]):
                first = int(stop[lo] - count[lo])
                words, group_words, escapes = encode(ids[first : int(stop[hi - 1])])
                rows.append({"shard": shard, "block": block, "ids_before": before, "doc_ids": names[lo:hi], "doc_ends": (stop[lo:hi] - first).tolist(), "words": words.astype("<u8").tobytes(), "group_words": group_words.tolist(), "escapes": escapes.tolist(), "n_ids": int(stop[hi - 1]) - first})
                block, before = block + 1, before + int(stop[hi - 1]) - first
            yield pa.RecordBatch.from_pylist(rows, schema=_BLOCK_SCHEMA)

    ordered = docs.select(doc_id, F.coalesce(text, F.lit("")).alias(text)).repartitionByRange(workspace.partitions(spark), F.col(doc_id).asc_nulls_first()).sortWithinPartitions(F.col(doc_id).asc_nulls_first(), text)
    return work, work.write(ordered.mapInArrow(run, BLOCKS), "blocks")


_BLOCK_SCHEMA = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("ids_before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int64())), ("words", pa.binary()), ("group_words", pa.list_(pa.int64())), ("escapes", pa.list_(pa.decimal128(20, 0))), ("n_ids", pa.int64())])


def read_documents(blocks: DataFrame, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of some documents; only blocks that have them are read, and only their groups decoded."""
    wanted = set(doc_ids)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, escapes = np.frombuffer(row["words"], "<u8"), np.array([int(x) for x in row["escapes"]], U)
                start = [0, *row["doc_ends"]]
                names = [(i, d) for i, d in enumerate(row["doc_ids"]) if d in wanted]
                ids = [decode_range(words, row["group_words"], escapes, start[i], start[i + 1]).astype(np.int64) for i, _ in names]
                yield pa.RecordBatch.from_arrays([pa.array([d for _, d in names], pa.int64()), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    having = F.arrays_overlap("doc_ids", F.array(*(F.lit(d).cast("long") for d in sorted(wanted))))
    return blocks.where(having if wanted else F.lit(False)).select("doc_ids", "doc_ends", "words", "group_words", "escapes").mapInArrow(run, "doc_id long, ids array<long>")


def read_ids(blocks: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, start, ids) of each document of the blocks, or (doc_id, start, n_tokens, ids_crc32) with digest.

    start counts the ids of all documents before it; the driver sees one total a shard.
    """
    spark = blocks.sparkSession
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # as many rows as shuffle partitions
    before, offsets = 0, {}
    for row in totals:
        offsets[row["shard"]] = before
        before += row["n"]
    offsets = spark.sparkContext.broadcast(offsets)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode(np.frombuffer(row["words"], "<u8"), np.array([int(x) for x in row["escapes"]], U))
                assert len(ids) == row["n_ids"], "a block's words disagree with its number of ids"
                stop = np.array(row["doc_ends"], np.int64)
                start = np.concatenate([[0], stop[:-1]])
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(start + offsets.value[row["shard"]] + row["ids_before"])]
                if digest:
                    raw = memoryview(ids.astype("<u4").tobytes())
                    columns += [pa.array(stop - start), pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(start, stop)], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])
                else:
                    lists = pa.ListArray.from_arrays(pa.array(np.append(start, stop[-1]), pa.int32()), pa.array(ids.astype(np.int64)))
                    yield pa.RecordBatch.from_arrays([*columns, lists], ["doc_id", "start", "ids"])

    schema = "doc_id long, start long, " + ("n_tokens long, ids_crc32 long" if digest else "ids array<long>")
    return blocks.select("shard", "ids_before", "doc_ids", "doc_ends", "words", "escapes", "n_ids").mapInArrow(run, schema)
