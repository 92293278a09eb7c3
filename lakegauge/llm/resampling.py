"""Target-distribution importance resampling of documents, without replacement.

Features are runs of up to `longest` words, hashed to a fixed number of buckets. A pass counts the
buckets of the corpus and of the target texts, one array a task; the logarithms of their smoothed
shares make an array of gains. A second pass weighs each document by a gather from that array and
adds Gumbel noise that depends on the doc_id alone, so the highest scores are an exact draw.

The draw: every partition of the scored rows is sorted into a run, which is cut at common splitters
into blocks and written. The blocks of a range between two splitters, from all runs, come together in
order of their first rows, and a tournament tree over the runs' heads merges them. The rows of each
range are counted before, so every merge knows its first rank, ranges beyond the draw are not read,
and the range in which the draw ends stops at its last row. Nothing but the counts of the buckets, a
row for each range and a sample of SAMPLE keys for the splitters, which change no result, reaches the
driver.

Defined results: null and wordless texts have no features and weight 0; documents of fewer than
least_words words are not drawn; a row with a null doc_id has a weight, but no score and no part in the
draw; rows that repeat are rows of their own, in any order among themselves; without target texts T is
0 and every gain comes from the corpus alone; columns beyond doc_id and text are not returned.
"""

import math
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext
from .arrowtext import Words
from .crc import crc32
from .workspace import Workspace, partitions, prepare

BUCKETS = 10_000
SEED = 2024
#: Keys that choose the splitters, and rows that a range should have; at most a range for every 32 keys.
SAMPLE, RANGE_ROWS = 1 << 16, 1 << 16
#: Text that is taken apart at a time.
TOGETHER = 2 << 20


def features(column, longest: int = 1, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every feature of a column of texts, in no order, and the words of each row."""
    words = Words(*arrowtext.column(column), arrowtext.NOT_ALNUM, hashed=False)
    space = np.frombuffer(b" ", np.uint8)
    code = crc32(words.data, words.start, words.end)
    found, rows = [code % buckets], [words.doc]
    for k in range(1, longest):
        # a run's code is carried on over a space and the next word
        same = words.doc[k:] == words.doc[: len(words.doc) - k] if len(words.doc) > k else np.zeros(0, bool)
        at = np.flatnonzero(same)
        spaced = crc32(space, np.zeros(len(at), np.int64), np.ones(len(at), np.int64), code[at])
        code = np.full(len(words.doc), 0, np.int64)
        code[at] = crc32(words.data, words.start[at + k], words.end[at + k], spaced)
        found.append(code[at] % buckets)
        rows.append(words.doc[at])
    return np.concatenate(found), np.concatenate(rows), words.count


def counts(texts: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts are in each bucket; a task passes on one row for each bucket at most."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for part in arrowtext.joined(batches, text, TOGETHER):
            total += np.bincount(features(part.column(0), longest, buckets)[0], minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row for each bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the target's smoothed share over the corpus's, by bucket, rounded down."""
    s_all, t_all = int(corpus.sum()) + len(corpus), int(target.sum()) + len(target)
    return np.array([math.floor(1000 * math.log(float(t + 1) * s_all / (float(s + 1) * t_all))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = 1, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of each row of docs (doc_id, text)."""
    buckets = len(gain)

    def run(batches):
        for part in arrowtext.joined(batches, "text", TOGETHER):
            bucket, row, words = features(part.column(1), longest, buckets)
            order = np.argsort(row, kind="stable") if longest > 1 else slice(None)
            total = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
            many = np.bincount(row, minlength=part.num_rows)
            stop = np.cumsum(many)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words.astype(np.int64)), pa.array(many.astype(np.int64)), pa.array(total[stop] - total[stop - many])], ["doc_id", "n_words", "n_features", "weight"])

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return found.withColumn("score", F.col("weight") + noise)


class Tournament:
    """A winner tree over the heads of sorted runs: each node names the run below it whose head is least."""

    NONE = (math.inf,)

    def __init__(self, runs: int):
        self.size = 1 << max(0, runs - 1).bit_length()
        self.heads = [self.NONE] * self.size
        self.tree = [0, *((i << (self.size.bit_length() - i.bit_length())) - self.size for i in range(1, 2 * self.size))]

    def put(self, run: int, head: tuple) -> None:
        """The run's head from now on; NONE at its end. Its matches up to the root are played again."""
        self.heads[run] = head
        heads, tree, node = self.heads, self.tree, (run + self.size) >> 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = b if heads[b] < heads[a] else a
            node >>= 1

    def least(self) -> tuple[int, tuple]:
        return (run := self.tree[1]), self.heads[run]


_ROW = ("score", "doc_id", "row", "n_features", "weight")
_LISTS = ", ".join(f"{c} array<long>" for c in _ROW)
_BLOCK = f"range int, run int, first_score long, first_doc long, first_row long, n long, {_LISTS}"


def _cuts(score: np.ndarray, doc: np.ndarray, splitters: list[tuple[int, int]]) -> np.ndarray:
    """How many rows, sorted by descending score and then doc_id, come before each splitter."""
    if not splitters:
        return np.zeros(0, np.int64)
    by_score, by_doc = np.array([s for s, _ in splitters]), np.array([d for _, d in splitters])
    low, high = np.searchsorted(-score, -by_score, "left"), np.searchsorted(-score, -by_score, "right")
    for i in np.flatnonzero(high > low):
        low[i] += np.searchsorted(doc[low[i] : high[i]], by_doc[i], "left")
    return low


def _blocks(scored: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """Each partition as a sorted run, in blocks that lie between two splitters."""

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy() for i in range(len(_ROW))]
            edges = np.concatenate([[0], _cuts(columns[0], columns[1], splitters), [batch.num_rows]])
            for i in np.flatnonzero(np.diff(edges) > 0):
                lo, hi = edges[i], edges[i + 1]
                lists = [pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), pa.array(c[lo:hi])) for c in columns]
                head = [pa.array([x], pa.int64()) for x in (*(c[lo] for c in columns[:3]), hi - lo)]
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([number], pa.int32()), *head, *lists], ["range", "run", "first_score", "first_doc", "first_row", "n", *_ROW])

    return scored.select(*_ROW).sortWithinPartitions(F.desc("score"), "doc_id", "row").mapInArrow(run, _BLOCK)


def _merged(blocks: DataFrame, runs: int, before: dict[int, int], wanted: int) -> DataFrame:
    """The wanted first rows of the blocks with their ranks; before: the rows ahead of each range."""
    out = pa.schema([(c, pa.int64()) for c in (*_ROW, "rank")])

    def rows(tree: Tournament, arriving, left: int):
        """The rows of a range in order: blocks come by their first rows, so a run's next one is there before it is needed."""
        held: dict[int, list] = {}  # of each run, an iterator of its present block and the blocks after it
        block = next(arriving, None)
        while left > 0:
            run, head = tree.least()
            if block is not None and block[1] <= head[:3]:
                if block[0] in held:
                    held[block[0]][1].append(block[2])
                else:
                    held[block[0]] = [(x := iter(block[2])), []]
                    tree.put(block[0], next(x))
                block = next(arriving, None)
                continue
            if head is Tournament.NONE:
                return
            yield head
            left -= 1
            now, later = held[run]
            if (following := next(now, None)) is None and later:
                held[run][0] = now = iter(later.pop(0))
                following = next(now)
            if following is None:
                del held[run]
            tree.put(run, following or Tournament.NONE)

    def run(batches):
        def arrivals():
            for batch in batches:
                for b in batch.to_pylist():
                    yield b["range"], (b["run"], (-b["first_score"], b["first_doc"], b["first_row"]), zip((-s for s in b["score"]), *(b[c] for c in _ROW[1:])))

        for number, of_range in groupby(arrivals(), key=lambda x: x[0]):
            done, held = before[number], []
            for head in rows(Tournament(runs), (b for _, b in of_range), wanted - done):
                done += 1
                held.append((-head[0], *head[1:], done))
                if len(held) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*held)], schema=out)
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*held)], schema=out)

    sorted_ = blocks.repartition(partitions(blocks.sparkSession), "range").sortWithinPartitions("range", F.desc("first_score"), "first_doc", "first_row")
    return sorted_.mapInArrow(run, ", ".join(f"{c} long" for c in (*_ROW, "rank")))


def draw(scored: DataFrame, percent: int = 10, least_words: int = 20, work: Workspace | None = None) -> DataFrame:
    """scored (a row each, from weigh) with rank: 1, 2, 3... by descending score, ties by doc_id, of floor(percent * N / 100) of the N rows that can be drawn."""
    spark = scored.sparkSession
    work = work or Workspace(spark, "resampling")
    scored = work.write(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    eligible = scored.where((F.col("n_words") >= least_words) & F.col("doc_id").isNotNull())
    total = eligible.count()
    wanted = total * percent // 100
    splitters = []
    if total > RANGE_ROWS:
        share = min(1.0, SAMPLE / total)
        picked = eligible.where(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30))).select("score", "doc_id").distinct().orderBy(F.desc("score"), "doc_id")
        keys = [(r[0], r[1]) for r in picked.collect()]  # SAMPLE on average, however many rows there are
        ranges = max(1, min(len(keys) // 32, -(-total // RANGE_ROWS)))
        splitters = [keys[i * len(keys) // ranges] for i in range(1, ranges)]
    blocks = work.write(_blocks(eligible, splitters), "runs")
    before, ahead = {}, 0
    sizes = blocks.groupBy("range").agg(F.sum("n").alias("n"), F.max("run").alias("run")).orderBy("range").collect()  # a row for each range
    for r in sizes:
        before[r["range"]], ahead = ahead, ahead + r["n"]
    needed = [i for i, n in before.items() if n < wanted]
    runs = max((r["run"] for r in sizes), default=0) + 1
    columns = ["doc_id", "n_features", "weight", "score"]
    if not needed:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    drawn = work.write(_merged(blocks.where(F.col("range") <= max(needed)), runs, before, wanted), "drawn")
    end = drawn.where(F.col("rank") == wanted).first()
    after = (F.col("score") < end["score"]) | (F.col("score") == end["score"]) & ((F.col("doc_id") > end["doc_id"]) | (F.col("doc_id") == end["doc_id"]) & (F.col("row") > end["row"]))
    chosen = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull() & ~after
    rest = scored.where(~F.coalesce(chosen, F.lit(False))).select(*columns, F.lit(None).cast("long").alias("rank"))
    return rest.unionByName(drawn.select(*columns, "rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every row of docs, drawn towards the texts of target."""
    prepare(docs.sparkSession)
    gain = gains(counts(docs, longest=longest, buckets=buckets), counts(target, longest=longest, buckets=buckets))
    found = draw(weigh(docs.select("doc_id", "text"), gain, longest, seed), percent, least_words)
    return found.select("doc_id", "n_features", "weight", "score", "rank")
