"""Substring dedup by sliding sentence spans.

Runs of at least RUN consecutive sentences, as many as it takes to reach MIN_WORDS words, are hashed
(128 bits over their words, letters lower-cased): the shortest from every sentence of a document and
the shortest that ends at every sentence. So is a whole document of RUN sentences or more, however few
words it has, and a sentence of ALONE words or more is a run by itself. A run that is not the first of
its hash, first by doc_id and then place, covers its sentences, and covered sentences are removed: of
a repeated passage with RUN sentences and MIN_WORDS words each sentence is covered, by the run from its
beginning if fewer words lie before, or else by that which ends at the sentence. A sentence ends
after . ! or ? before white space, at a line break, and at the end. Shorter passages stay, as stock
phrases, unless they are whole documents. Runs inside one document repeat as those of several do.

Defined results: null text stays null, text without repeats stays as it is; a document of one
sentence with MIN_WORDS words is one run, one of fewer words stays; rows that share a doc_id and text are ordered by nothing
but their equal text, so each keeps what the first keeps; removed sentences go with the white
space behind them; rows with null doc_id come after all others; extra columns pass through, but for ones named as
those made here.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext
from .arrowtext import U, Words
from .workspace import Workspace, ddl, without

RUN = 2
MIN_WORDS = 20
#: Words of a sentence that is a run by itself: over 50.
ALONE = 51
_END = np.isin(np.arange(256), list(b".!?"))


class Sentences:
    """start: byte places, the next start or the document's end is the end; doc; first word and number of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = words = Words(data, offsets, arrowtext.SPACE)
        n = len(words.start)
        first = np.zeros(n, bool)
        if n:
            first[words.first[words.count > 0]] = True
            closes = _END[data[words.end - 1]]
            lines = np.concatenate([[0], np.cumsum((data == 10) | (data == 13))])
            broken = lines[words.start[1:]] > lines[words.end[:-1]]
            first[1:] |= closes[:-1] | broken
        self.word = np.flatnonzero(first)
        self.start, self.doc = words.start[self.word], words.doc[self.word]
        self.size = np.diff(self.word, append=n)
        self.rank = np.arange(len(self.word)) - np.searchsorted(self.doc, self.doc)
        self.per_doc = np.bincount(self.doc, minlength=words.rows)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First sentence, last-plus-one sentence and two hashes of every run."""
        n = len(self.word)
        a = np.arange(n)
        edges = np.append(self.word, len(self.words.hash))
        least = np.minimum(RUN, self.per_doc[self.doc])
        b = np.maximum(a + least, np.searchsorted(edges, edges[:-1] + MIN_WORDS))
        keep = b <= a - self.rank + self.per_doc[self.doc]
        a, b = a[keep], b[keep]
        if n:
            last = np.arange(1, n + 1)
            begin = np.minimum(last - least, np.searchsorted(edges, edges[1:] - MIN_WORDS, "right") - 1)
            inside = begin >= last - 1 - self.rank
            alone = np.flatnonzero(self.size >= ALONE)
            heads = np.flatnonzero((self.rank == 0) & (self.per_doc[self.doc] >= RUN))
            whole = heads + self.per_doc[self.doc[heads]]
            pairs = np.concatenate([a * (n + 1) + b, begin[inside] * (n + 1) + last[inside], alone * (n + 1) + alone + 1, heads * (n + 1) + whole])
            a, b = np.divmod(np.unique(pairs), n + 1)
        one, two = arrowtext.run_hashes(self.words.hash, edges[a], edges[b], 2)
        return a, b, one, two


def _runs(docs: DataFrame) -> DataFrame:
    def run(batches):
        for part in arrowtext.slices(batches, "text"):
            s = Sentences(*arrowtext.column(part.column(1)))
            a, b, one, two = s.runs()
            ids = part.column(0).take(pa.array(s.doc[a]))
            digest = part.column(2).take(pa.array(s.doc[a]))
            yield pa.RecordBatch.from_arrays([ids, digest, pa.array(s.rank[a].astype(np.int32)), pa.array((b - a).astype(np.int32)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], ["doc", "digest", "place", "length", "one", "two"])

    return docs.mapInArrow(run, "doc long, digest long, place int, length int, one long, two long")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with text cut, n_sentences, n_removed and removed_bytes."""
    work = Workspace(docs.sparkSession, "sentences")
    docs = without(docs, "n_sentences", "n_removed", "removed_bytes", "_doc", "_digest", "_cuts")
    named = docs.select(F.coalesce(F.col(doc_id), F.lit(2**63 - 1)).alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("digest"))
    runs = _runs(named)
    first = F.min(F.struct("doc", "digest", "place"))
    firsts = runs.groupBy("one", "two").agg(F.count("*").alias("n"), first.alias("first")).where("n > 1")
    repeated = work.write(firsts.select("one", "two", "first"), "repeated")
    # both sides of this join are fresh, so Spark may split the partition of a frequent run
    covered = runs.join(repeated, ["one", "two"])
    covered = covered.where(F.struct("doc", "digest", "place") != F.col("first")).select("doc", "digest", "place", "length")
    per_doc = covered.groupBy("doc", "digest").agg(F.collect_set(F.shiftleft(F.col("place").cast("long"), 32) + F.col("length")).alias("_cuts"))
    cuts = work.write(per_doc, "cuts")
    names = docs.columns
    keyed = docs.withColumn("_doc", F.coalesce(F.col(doc_id), F.lit(2**63 - 1))).withColumn("_digest", F.xxhash64(text))
    joined = keyed.join(cuts, (F.col("_doc") == cuts.doc) & (F.col("_digest") == cuts.digest), "left").select(*(keyed[c] for c in names), "_cuts")
    schema = f"{ddl(docs)}, n_sentences long, n_removed long, removed_bytes long"

    def run(batches):
        for part in arrowtext.slices(batches, text):
            at = part.schema.get_field_index(text)
            column = part.column(at)
            data, offsets = arrowtext.column(column)
            s = Sentences(data, offsets)
            gone = np.zeros(len(s.word) + 1, np.int64)
            first = np.concatenate([[0], np.cumsum(s.per_doc)])
            for r, cuts in enumerate(part.column(part.schema.get_field_index("_cuts")).to_pylist()):
                for c in cuts or ():
                    place, length = c >> 32, c & 0xFFFFFFFF
                    gone[first[r] + place] += 1
                    gone[first[r] + place + length] -= 1
            gone = np.cumsum(gone[:-1]) > 0
            removed = np.bincount(s.doc, gone, minlength=s.words.rows).astype(np.int64)
            raw, texts = data.tobytes(), column.to_pylist()
            less = np.zeros(s.words.rows, np.int64)
            for r in np.flatnonzero(removed):
                own = slice(first[r], first[r + 1])
                ends = np.append(s.start[own][1:], offsets[r + 1])
                kept = raw[offsets[r] : s.start[own][0]] + b"".join(raw[a:b] for a, b, g in zip(s.start[own], ends, gone[own]) if not g)
                less[r] = offsets[r + 1] - offsets[r] - len(kept)
                texts[r] = kept.decode("utf-8", "replace")
            columns = [pa.array(texts, pa.string()) if i == at else part.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(s.per_doc.astype(np.int64)), pa.array(removed), pa.array(less)], [*names, "n_sentences", "n_removed", "removed_bytes"])

    return joined.mapInArrow(run, schema)
