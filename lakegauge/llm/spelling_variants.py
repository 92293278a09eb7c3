"""Groups of spelling variants: words one edit apart, by Aho-Corasick automata over halves of words.

Words are maximal runs of Latin letters, counted over all texts; what tasks pass on is a count for each
of their words. Of two words that differ by one inserted, deleted or replaced character, at least one
half of either is whole in the other, at its start or up to its end. So every word is cut into two
segments, its first half and the rest, and automata in shards hold the segments of all words. All words
are scanned: a hit counts if the segment lies at the offset it has in its own word, from the start or
from the end, and the lengths differ by one at most. Whether the rest of the two words is one edit apart
is looked up among the rest's forms with one character left out, so words that share a segment are never
compared in pairs; only rests of over LONG characters are, with each other alone.

A shard holds the words of the segments that hash to it, and a word is sent to the shards of the
segments that words of its length, one less or one more could share with it; each pair is found at the
first half where that is whole, at the second one otherwise. A segment of very many words or scans is
dealt over a grid of shards in which every word still meets every other once. For each word a shard
passes on a count and its best neighbour. Roots are found by doubling pointers: a form has at least ten
times the count, so chains are short.

Defined results: null and empty texts have no words; a null doc_id garbles nothing; rows that repeat
count each; words may be of any length; without words the result is empty; of neighbours with equal counts
the smallest in code-point order is taken; other columns of docs are not used.
"""

import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext
from .crc import crc32
from .workspace import Workspace, partitions, prepare, small

LEAST, GARBLED, TIMES = 7, 31, 10
#: Text that is taken apart at a time, and words that a task counts together.
TOGETHER, COUNTED = 1 << 20, 1 << 19
#: Words of a shard, and scans of one segment, beyond which a segment is dealt over a grid.
SHARD_WORDS, SHARD_SCANS = 20_000, 100_000
#: Rests of more characters are compared directly.
LONG = 64

LEAD = 0xC3  # the first byte of U+00C0 to U+00FF
LETTER = np.zeros(256, bool)
LETTER[ord("a") : ord("z") + 1] = True
LETTER[LEAD] = True


def garbled_runs(texts, doc_ids, least: int = LEAST, one_in: int = GARBLED) -> pa.Array:
    """Every run of at least `least` letters, lower-cased in A-Z, without the letter that its hash names where one_in divides that."""
    raw, offsets = arrowtext.column(texts)
    data, n = arrowtext.LOWER[raw], len(raw)
    inside = LETTER[data]
    inside[1:] |= data[:-1] == LEAD
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    begins = inside & ((data & 0xC0) != 0x80)
    points = np.concatenate([[0], np.cumsum(begins)])
    keep = points[end] - points[start] >= least
    start, end = start[keep], end[keep]
    size = points[end] - points[start]
    doc = np.searchsorted(offsets, start, side="right") - 1
    ids = doc_ids.to_pylist()
    prefix = np.array([0 if x is None else zlib.crc32(b"%d:" % x) for x in ids] or [0], np.uint32)
    h = crc32(data, start, end, prefix[doc])
    hit = (h % one_in == 0) & np.array([x is not None for x in ids] or [False])[doc]
    place = np.flatnonzero(begins)[points[start[hit]] + h[hit] % size[hit]]
    gone = np.zeros(n + 1, bool)
    gone[place] = True
    gone[place[data[place] == LEAD] + 1] = True
    left = end - start
    left[hit] -= 1 + (data[place] == LEAD)
    # a garbled run may be too short now
    enough = size - hit >= least
    start, end, left = start[enough], end[enough], left[enough]
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    kept = data[(np.cumsum(edge[:-1]) > 0) & ~gone[:-1]]
    place = np.concatenate([[0], np.cumsum(left)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(left), [None, pa.py_buffer(place.tobytes()), pa.py_buffer(kept.tobytes())])


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST, least_count: int = 2, one_in: int = GARBLED) -> DataFrame:
    """(word, n) of all words with at least `least` letters and `least_count` occurrences."""

    def flush(held):
        found = pc.value_counts(pa.chunked_array(held))
        return pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])

    def run(batches):
        held, size = [], 0
        for part in arrowtext.joined(batches, "text", TOGETHER):
            held.append(garbled_runs(part.column(1), part.column(0), least, one_in))
            size += len(held[-1])
            if size >= COUNTED:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    parts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def one_edit(a: str, b: str) -> bool:
    """Whether the strings differ by exactly one inserted, deleted or replaced character."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)
    while low < high:  # the common start, by halving
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return a[low + 1 :] == b[low + 1 :] if len(a) == len(b) else a[low:] == b[low + 1 :]


class Rests:
    """What stands beside a segment in its words, to be asked which rests are one edit away from another."""

    def __init__(self):
        self.whole, self.less, self.long = {}, {}, []

    def add(self, rest: str, word: int) -> None:
        if len(rest) > LONG:
            self.long.append((rest, word))
            return
        self.whole[rest] = word
        for i in range(len(rest)):
            self.less.setdefault(rest[:i] + rest[i + 1 :], []).append((i, rest[i], word))

    def near(self, rest: str) -> set[int]:
        found = {w for _, _, w in self.less.get(rest, ())}  # one character more
        if len(rest) <= LONG + 1:
            for i, c in enumerate(rest):
                key = rest[:i] + rest[i + 1 :]
                if (w := self.whole.get(key)) is not None:  # one less
                    found.add(w)
                found.update(w for j, d, w in self.less.get(key, ()) if i == j and c != d)
        if self.long and len(rest) >= LONG:
            found.update(w for r, w in self.long if one_edit(rest, r))
        return found


class Halves:
    """An automaton of both segments of a shard's words."""

    def __init__(self):
        self.words, self.counts, self.groups = [], [], {}

    def add(self, word: str, n: int, suffix: bool) -> None:
        half, number = len(word) // 2, len(self.words)
        self.words.append(word)
        self.counts.append(n)
        segment, rest = (word[half:], word[:half]) if suffix else (word[:half], word[half:])
        self.groups.setdefault(segment, (Rests(), Rests()))[suffix].add(rest, number)

    def finish(self) -> "Halves":
        self.automaton = ahocorasick.Automaton()
        for segment, groups in self.groups.items():
            self.automaton.add_word(segment, (len(segment), *groups))
        self.automaton.make_automaton()
        return self

    def scan(self, word: str, wanted: set[tuple[bool, int]]) -> tuple[int, int, str] | None:
        """How many of the words held are near by segments of the wanted sides and lengths, and count and name of the best."""
        number, best, size = 0, None, len(word)
        if not self.groups:
            return None
        for last, (length, firsts, seconds) in self.automaton.iter(word):
            first = last + 1 - length
            found = firsts.near(word[length:]) if first == 0 and (False, length) in wanted else ()
            # a pair whose first half is whole too is found there
            more = [w for w in seconds.near(word[:first]) if not word.startswith(self.words[w][: len(self.words[w]) // 2])] if last == size - 1 and (True, length) in wanted else ()
            for w in (*found, *more):
                number += 1
                key = (-self.counts[w], self.words[w])
                best = key if best is None or key < best else best
        return best and (number, -best[0], best[1])


def _segments(words: DataFrame) -> DataFrame:
    """A row for each segment of a word (scan false) and each that a near word could share with it (scan true)."""
    size = F.char_length("word")
    half = lambda n: F.floor(n / 2).cast("int")
    rest = lambda n: (n - F.floor(n / 2)).cast("int")
    entry = lambda suffix, length, scan: F.struct(F.lit(suffix).alias("suffix"), length.alias("length"), F.lit(scan).alias("scan"))
    own = [entry(False, half(size), False), entry(True, rest(size), False)]
    asked = [entry(suffix, f(size + d), True) for suffix, f in ((False, half), (True, rest)) for d in (-1, 0, 1)]
    found = words.select("word", "n", F.explode(F.array_distinct(F.array(*own, *asked))).alias("s")).where((F.col("s.length") > 0) & (F.col("s.length") <= size))
    segment = F.when(F.col("s.suffix"), F.substr("word", size - F.col("s.length") + 1)).otherwise(F.substr("word", F.lit(1), F.col("s.length")))
    return found.select("word", "n", F.col("s.suffix").alias("suffix"), F.col("s.length").alias("length"), F.col("s.scan").alias("scan"), F.xxhash64("s.suffix", segment).alias("segment"))


def _scanned(words: DataFrame, shard_words: int = SHARD_WORDS, shard_scans: int = SHARD_SCANS) -> DataFrame:
    """(word, n_near, best_n, best) of the words of a table (word, n) that have near words, a row for each shard that has some."""
    spark = words.sparkSession
    total = words.count()
    shards = max(partitions(spark), -(-2 * total // shard_words))
    segments = _segments(words)
    held, asked = F.count_if(~F.col("scan")), F.count_if("scan")
    # hot segments number 8 words in shard_words at most
    grid = segments.groupBy("segment").agg(F.ceil(held / shard_words).alias("p"), F.ceil(asked / shard_scans).alias("q")).where("p > 1 or (p = 1 and q > 1)")
    dealt = segments.join(small(grid), "segment", "left")
    p, q, own = F.coalesce("p", F.lit(1)), F.coalesce("q", F.lit(1)), F.xxhash64("word", F.lit(17))
    row = F.when(F.col("scan"), F.sequence(F.lit(0).cast("long"), p - 1)).otherwise(F.array(F.pmod(own, p)))
    column = F.when(F.col("scan"), F.array(F.pmod(own, q))).otherwise(F.sequence(F.lit(0).cast("long"), q - 1))
    placed = dealt.select("word", "n", "suffix", "length", "scan", "segment", "p", F.explode(row).alias("i"), column.alias("j")).withColumn("j", F.explode("j"))
    # a cell of a grid is a shard of its own
    shard = F.when(F.col("p").isNull(), F.pmod("segment", F.lit(shards))).otherwise(shards + F.shiftrightunsigned(F.xxhash64("segment", "i", "j"), 2))

    def run(batches):
        shard, halves, word, wanted = None, None, None, set()

        def scanned():
            if word is not None and wanted and (found := halves.scan(word, wanted)):
                yield (word, *found)

        def rows():
            nonlocal shard, halves, word, wanted
            for batch in batches:
                for s, scan, w, suffix, length, n in zip(*(batch.column(i).to_pylist() for i in range(6))):
                    if s != shard:
                        yield from scanned()
                        shard, halves, word, wanted = s, Halves(), None, set()
                    if not scan:
                        halves.add(w, n, suffix)
                        continue
                    if word is None:
                        halves.finish()
                    if w != word:
                        yield from scanned()
                        word, wanted = w, set()
                    wanted.add((suffix, length))
            yield from scanned()

        held = []
        for found in rows():
            held.append(found)
            if len(held) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held)], _FOUND)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held)], _FOUND)

    met = placed.withColumn("shard", shard).repartition(shards, "shard").sortWithinPartitions("shard", "scan", "word").select("shard", "scan", "word", "suffix", "length", "n")
    return met.mapInArrow(run, "word string, n_near long, best_n long, best string")


def _summed(found: DataFrame, *more) -> DataFrame:
    """A row for each word: near words of all shards, and the best; one shuffle and one sort."""
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))))
    made = found.repartition("word").groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"), *more)
    return made.withColumns({"best_n": -F.col("b.less"), "best": F.col("b.word")}).drop("b")


def neighbours(words: DataFrame, **limits) -> DataFrame:
    """(word, n_near, best_n, best) of the words of a table (word, n) that have near words."""
    return _summed(_scanned(words, **limits))


_FOUND = ["word", "n_near", "best_n", "best"]


def roots(forms: DataFrame, work: Workspace) -> DataFrame:
    """(word, form, root): the last word of each chain of forms, by doubled pointers."""
    now, number = work.write(forms.select("word", "form", F.col("form").alias("root")), "roots-0"), 0
    while True:
        step = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        further = now.join(step, F.col("root") == F.col("_word"), "left")
        number += 1
        after = work.write(further.select("word", "form", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), f"roots-{number}")
        now = after.drop("moved")
        if not after.where("moved").limit(1).count():
            return now


def variants(docs: DataFrame, times: int = TIMES, **options) -> DataFrame:
    """word, form, root, n, n_near and form_n of all words of docs (doc_id, text)."""
    prepare(docs.sparkSession)
    work = Workspace(docs.sparkSession, "spelling")
    words = work.write(word_counts(docs, **options), "words")
    every = _summed(_scanned(words).unionByName(words, allowMissingColumns=True), F.max("n").alias("n"))
    has = F.col("best_n") >= F.col("n") * times
    every = work.write(every.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "near")
    found = roots(every.where("form is not null").select("word", "form"), work).select("word", "root")
    return every.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
