"""Benchmark decontamination by an FM-index of each training shard.

A shard is a run of whole documents, about SHARD_BYTES of text or one longer document. Its text is the sequence of word numbers in the benchmark's
vocabulary; words that no benchmark item has, and the ends of documents, all are one separator, and
runs of words shorter than the shortest phrase are left out, as no phrase can lie in them. The
shard's suffix array gives its Burrows-Wheeler transform, whose ranks a wavelet matrix answers.
All phrases whose words the shard has are searched backward together; each occurrence steps back to
a sampled suffix position, and the spans of words found are merged in the document.

Words are compared by 64-bit hashes, and phrases by 128 bits over those. Defined results: null or
empty text has no words; an item of fewer words than the window is one phrase, one without words
has none; items with equal phrases all count; a null item_id is named None; rows that repeat are
judged each; a text that is longer than a shard is one shard; without items, or without
documents, nothing is hit; extra columns pass through, but for ones named as those made here.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext
from .arrowtext import U, Words
from .workspace import Workspace, ddl, prepare, without

WINDOW = 13
SAMPLE = 8
#: A pass over the documents searches the phrases of items with at most so many bytes of text.
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 2 << 20


class WaveletMatrix:
    """Ranks in a sequence of small numbers: one bit vector with counts a level, most significant first."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (values >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            order = bit.astype(bool)
            self.zeros.append(int((~order).sum()))
            values = np.concatenate([values[~order], values[order]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        lo, hi = np.zeros_like(place), place
        for k in range(self.bits):
            bit = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            ones = self.ones[k]
            a, b = ones[lo], ones[hi]
            lo, hi = np.where(bit, self.zeros[k] + a, lo - a), np.where(bit, self.zeros[k] + b, hi - b)
        return hi - lo

    def access(self, place: np.ndarray) -> np.ndarray:
        found = np.zeros_like(place)
        for k in range(self.bits):
            ones = self.ones[k]
            bit = ones[place + 1] - ones[place]
            found = found * 2 + bit
            place = np.where(bit > 0, self.zeros[k] + ones[place], place - ones[place])
        return found


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; a suffix that ends is least. Only unsettled groups are sorted again."""
    n = len(values)
    rank = np.unique(values, return_inverse=True)[1].astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    rank = np.searchsorted(rank[order], rank, side="left").astype(np.int64)  # the first place of its group
    step, open_ = 1, np.arange(n)
    while True:
        size = np.bincount(rank, minlength=n)
        open_ = open_[size[rank[open_]] > 1]
        if not len(open_):
            break
        after = np.where(open_ + step < n, rank[np.minimum(open_ + step, n - 1)] + 1, 0)
        sort = np.lexsort((after, rank[open_]))
        group, key = rank[open_][sort], after[sort]
        begins = np.ones(len(sort), bool)
        begins[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        new_group = np.ones(len(sort), bool)
        new_group[1:] = group[1:] != group[:-1]
        index = np.arange(len(sort))
        within = np.maximum.accumulate(np.where(begins, index, 0)) - np.maximum.accumulate(np.where(new_group, index, 0))
        fresh = rank.copy()
        fresh[open_[sort]] = group + within
        rank, step = fresh, step * 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class FMIndex:
    """count and locate phrases of numbers from 1 on in a text in which 0 separates."""

    def __init__(self, values: np.ndarray, symbols: int):
        values = np.append(values + 1, 0).astype(np.int64)  # an end that occurs once makes all rotations distinct
        order = suffix_array(values)
        self.n = len(values)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(values, minlength=symbols + 2))])
        self.wavelet = WaveletMatrix(values[order - 1], int(symbols + 1).bit_length())
        sampled = (order % SAMPLE == 0) | (order == 0)
        self.marks = np.concatenate([[0], np.cumsum(sampled)])
        self.samples = order[sampled]

    def search(self, numbers: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one suffix of each phrase numbers[start : start + size]."""
        low, high = np.zeros(len(start), np.int64), np.full(len(start), self.n)
        for j in range(int(size.max(initial=0))):
            live = np.flatnonzero((size > j) & (low < high))
            if not len(live):
                break
            symbol = numbers[start[live] + size[live] - 1 - j].astype(np.int64) + 1
            base = self.first[symbol]
            low[live], high[live] = base + self.wavelet.rank(symbol, low[live]), base + self.wavelet.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, suffix: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, stepping back to a sampled one."""
        out, steps = np.zeros(len(suffix), np.int64), 0
        left, at = np.arange(len(suffix)), suffix
        while len(left):
            hit = self.marks[at + 1] > self.marks[at]
            out[left[hit]] = self.samples[self.marks[at[hit]]] + steps
            left, at = left[~hit], at[~hit]
            symbol = self.wavelet.access(at)
            at = self.first[symbol] + self.wavelet.rank(symbol, at)
            steps += 1
        return out


class Phrases:
    """Windows of the items as runs of vocabulary numbers, and the items of each; some 40 bytes for each word of the items."""

    def __init__(self, items: list[tuple[object, str]], window: int):
        words = Words(*arrowtext.column(pa.array([t for _, t in items], pa.string())), arrowtext.NOT_ALNUM)
        self.names = [str(name) for name, _ in items]
        self.vocabulary = np.unique(words.hash)
        self.numbers = (np.searchsorted(self.vocabulary, words.hash) + 1).astype(np.int32)
        many = np.where(words.count > 0, np.maximum(words.count - window + 1, 1), 0)
        item = np.repeat(np.arange(words.rows), many)
        start = np.repeat(words.first, many) + np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
        size = np.minimum(words.count, window)[item]
        one, two = arrowtext.run_hashes(words.hash, start, start + size, 2)
        order = np.lexsort((item, two, one))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
        self.start, self.size = start[order[fresh]].astype(np.int32), size[order[fresh]].astype(np.int32)
        self.item, self.of = item[order].astype(np.int32), np.append(np.flatnonzero(fresh), len(order))
        #: A table by the hashes' top bits to their numbers, so most words are told apart by one look.
        self.bits = max(12, int(len(self.vocabulary) * 16).bit_length())
        top = (self.vocabulary >> U(64 - self.bits)).astype(np.int64)
        self.slot = np.searchsorted(top, np.arange(1 << self.bits), side="left")
        self.deepest = int(np.bincount(top).max(initial=0))

    def number(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int64)
        if len(self.vocabulary):
            slot = self.slot[(hashes >> U(64 - self.bits)).astype(np.int64)]
            for k in range(self.deepest):
                at = np.minimum(slot + k, len(self.vocabulary) - 1)
                hit = self.vocabulary[at] == hashes
                out[hit] = at[hit] + 1
        return out

    def find(self, words: Words) -> tuple[np.ndarray, list[set]]:
        """Which words are hit, and each document's items."""
        hit, items = np.zeros(len(words.hash), bool), [set() for _ in range(words.rows)]
        if not len(self.start) or not len(words.hash):
            return hit, items
        number = self.number(words.hash)
        # runs of vocabulary words inside one document
        starts = np.flatnonzero((number > 0) & np.concatenate([[True], (number[:-1] == 0) | (words.doc[1:] != words.doc[:-1])]))
        stops = np.flatnonzero((number > 0) & np.concatenate([(number[1:] == 0) | (words.doc[1:] != words.doc[:-1]), [True]])) + 1
        keep = stops - starts >= self.size.min()
        starts, stops = starts[keep], stops[keep]
        if not len(starts):
            return hit, items
        length = stops - starts + 1  # with a separator
        end = np.cumsum(length)
        place = np.arange(end[-1]) - np.repeat(end - length, length) + np.repeat(starts, length)
        text = number[np.minimum(place, len(number) - 1)]
        text[end - 1] = 0
        # phrases of which the shard lacks a word cannot occur
        there = np.zeros(len(self.vocabulary) + 1, bool)
        there[text] = True
        likely = np.arange(len(self.start))
        for j in range(int(self.size.max())):
            likely = likely[there[self.numbers[self.start[likely] + np.minimum(j, self.size[likely] - 1)]]]
        if not len(likely):
            return hit, items
        index = FMIndex(text, len(self.vocabulary))
        low, high = index.search(self.numbers, self.start[likely], self.size[likely])
        count = high - low
        phrase = np.repeat(likely, count)
        at = index.locate(np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count))
        first = place[at]
        edge = np.zeros(len(hit) + 1, np.int64)
        np.add.at(edge, first, 1)
        np.add.at(edge, first + self.size[phrase], -1)
        hit = np.cumsum(edge[:-1]) > 0
        for doc, p in np.unique(np.stack([words.doc[first], phrase], 1), axis=0):
            items[doc].update(self.names[i] for i in self.item[self.of[p] : self.of[p + 1]])
        return hit, items


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int) -> list[DataFrame]:
    """The items in parts of about limit bytes."""
    size = benchmark.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64)).collect()[0][0] or 0
    parts = -(-size // limit)
    return [benchmark.where(F.pmod(F.xxhash64(item_id, text), F.lit(parts)) == i) for i in range(parts)]


def find_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with n_words, spans (array of first and last-plus-one word of merged hits) and items (sorted strings).

    Each pass over the documents takes a block of items of bounded size; with several blocks, the
    result of a pass is a table that the next one reads.
    """
    docs = without(docs, "n_words", "spans", "items")
    spark, names = docs.sparkSession, docs.columns
    prepare(spark)
    work, marks = Workspace(spark, "fm-index"), ["n_words", "spans", "items"]
    schema = f"{ddl(docs)}, n_words long, spans array<struct<first:long,last:long>>, items array<string>"
    span_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    blocks = _blocks(benchmark, item_id, item_text, block_bytes) or [benchmark.limit(0)]
    for i, block in enumerate(blocks):
        rows = [(r[0], r[1]) for r in block.select(item_id, item_text).collect()]  # of bounded size
        phrases = spark.sparkContext.broadcast(Phrases(rows, window))

        def run(batches, phrases=phrases, before=i > 0):
            for part in arrowtext.joined(batches, text, SHARD_BYTES):
                words = Words(*arrowtext.column(part.column(part.schema.get_field_index(text))), arrowtext.NOT_ALNUM)
                hit, items = phrases.value.find(words)
                if before:
                    for r, (spans, old) in enumerate(zip(part.column(part.schema.get_field_index("spans")).to_pylist(), part.column(part.schema.get_field_index("items")).to_pylist())):
                        items[r].update(old)
                        for s in spans:
                            hit[words.first[r] + s["first"] : words.first[r] + s["last"]] = True
                spans = [[] for _ in range(words.rows)]
                change = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0) == 1)
                change = np.union1d(change, np.flatnonzero(hit & np.diff(words.doc, prepend=-1).astype(bool)))
                stop = np.union1d(np.flatnonzero(np.diff(hit.astype(np.int8), append=0) == -1) + 1, np.flatnonzero(hit & np.diff(words.doc, append=-1).astype(bool)) + 1)
                for a, b in zip(change, stop):
                    r = words.doc[a]
                    spans[r].append({"first": int(a - words.first[r]), "last": int(b - words.first[r])})
                kept = [part.column(part.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(words.count), pa.array(spans, span_type), pa.array([sorted(x) for x in items], pa.list_(pa.string()))], [*names, *marks])

        docs = docs.mapInArrow(run, schema)
        if i + 1 < len(blocks):
            docs = work.write(docs, f"pass-{i}")
    return docs


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs with n_words, n_hit, n_items, items_sha256 and contaminated: a twentieth of the words or more are hit."""
    found = find_spans(without(docs, "n_hit", "n_items", "items_sha256", "contaminated"), benchmark, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return (
        found.withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.concat_ws(",", "items"), 256))
        .withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))
    )
