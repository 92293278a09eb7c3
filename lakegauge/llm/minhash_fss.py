"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

The sketch (Dahlgaard, Knudsen, Thorup 2017) has COORDINATES bins. Round i < t throws every
shingle into a hashed bin with value i + hash; round t + j throws all into bin j. A bin keeps its
least value, and rounds stop once all bins of a document are full, so after 2t rounds none is
empty and the estimate concentrates as a sum over independent bins does.

Documents with equal shingle sets become one class first. Classes meet in BANDS buckets of
ROWS coordinates (a pair at 0.85 misses all with probability 2e-6). In a bucket, every class is
compared with the bucket's least class, and if it is not linked to it with HUBS further ones. What
a bucket then still has in several components is joined exactly, without pairs of all: by prefix
filtering (Xiao and others 2008), two sets at the threshold share a shingle among the rarest few of
each, fewer still of the smaller set, so sets that differ in more than the threshold allows do not
meet even where they share all the rest. No link inside a bucket is lost, and neither linked
classes nor unlinked ones make all their pairs. Pairs that can be linked by their sizes and by the
parities of their numbers in ODD_BITS bins, which bound the difference of two sets from below, are
confirmed on the full sets of 64-bit shingle hashes.

Defined results: a null or wordless text has no shingles and no links; documents of fewer than
five words have their whole sequence as one shingle; rows that share a doc_id count as one
document with the links of all; a null doc_id has the component of its class, or null, and is kept;
columns beyond doc_id and text are not returned.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext
from .arrowtext import U, Words, fold, keys, mix
from .components import components
from .workspace import Workspace

SHINGLE = 5
BANDS, ROWS = 28, 6
COORDINATES = BANDS * ROWS
HUBS = 8
#: Bins of the parities that bound how far two sets differ.
ODD_BITS = 512
#: Bins in which shingles are counted to tell rare ones from frequent ones; the order of a prefix may be any, so a bin may hold several.
COUNT_BINS = 1 << 18


def shingles(words: Words, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle, repeats included, in the order of rows."""
    n = len(words.hash)
    if not n:
        return np.zeros(0, U), np.zeros(0, np.int64)
    if n >= width:
        whole = np.flatnonzero(words.doc[: n - width + 1] == words.doc[width - 1 :])
        hashes, rows = fold(words.hash, width, 11)[whole], words.doc[whole]
    else:
        hashes, rows = np.zeros(0, U), np.zeros(0, np.int64)
    short = np.flatnonzero((words.count > 0) & (words.count < width))
    if short.size:
        key, own = keys(12, width), []
        for r in short:  # at most width - 1 words each
            part = words.hash[words.first[r] : words.first[r] + words.count[r]]
            own.append((part * key[: len(part)]).sum(dtype=U))
        hashes = np.concatenate([hashes, mix(np.array(own, U) + words.count[short].astype(U))])
        rows = np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        hashes, rows = hashes[order], rows[order]
    return hashes, rows


def distinct_sets(hashes: np.ndarray, rows: np.ndarray, n: int) -> list[np.ndarray]:
    """Each row's distinct hashes in ascending order."""
    cut = np.searchsorted(rows, np.arange(n + 1))
    return [np.unique(hashes[a:b]) for a, b in zip(cut, cut[1:])]


def sketches(hashes: np.ndarray, rows: np.ndarray, n: int, t: int = COORDINATES) -> np.ndarray:
    """n rows of t bins; rows without shingles keep the greatest value throughout."""
    most = U(2**64 - 1)
    bins = np.full(n * t, most, U)
    seeds = keys(13, 2 * t)
    full = np.ones(n, bool)
    full[rows] = False
    for i in range(2 * t):
        if not len(hashes):
            break
        x = mix(hashes ^ seeds[i])
        place = ((x >> U(32)) * U(t)) >> U(32) if i < t else np.full(len(x), i - t, U)
        value = (U(i) << U(54)) | (mix(x) >> U(10))
        np.minimum.at(bins, rows * t + place.astype(np.int64), value)
        still = np.unique(rows)
        full[still] = (bins.reshape(n, t)[still] != most).all(axis=1)
        if full[still].any():
            left = ~full[rows]
            hashes, rows = hashes[left], rows[left]
    return bins.reshape(n, t)


def band_keys(bins: np.ndarray) -> np.ndarray:
    parts = bins.reshape(len(bins), BANDS, ROWS)
    out = (parts * keys(14, ROWS)).sum(axis=2, dtype=U)
    return mix(out + keys(15, BANDS))


def signatures(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, high, low, bands); high and low are 64-bit sums over the set, null for an empty set."""

    def run(batches):
        for part in arrowtext.slices(batches, text):
            words = Words(*arrowtext.column(part.column(part.schema.get_field_index(text))), arrowtext.SPACE)
            hashes, rows = shingles(words)
            sets = distinct_sets(hashes, rows, words.rows)
            size = np.array([len(s) for s in sets], np.int64)
            flat = np.concatenate(sets) if sets else hashes
            bands = band_keys(sketches(flat, np.repeat(np.arange(words.rows), size), words.rows)).view(np.int64)
            empty = size == 0
            stop = np.concatenate([[0], np.cumsum(size)])
            sums = []
            for seed in (16, 17):
                total = np.concatenate([np.zeros(1, U), np.cumsum(mix(flat ^ keys(seed, 1)[0]))])
                sums.append((total[stop[1:]] - total[stop[:-1]]).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(words.rows + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(doc_id)), pa.array(size), *(pa.array(s, mask=empty) for s in sums), lists], ["doc_id", "n_shingles", "high", "low", "bands"])

    return docs.select(doc_id, text).mapInArrow(run, "doc_id long, n_shingles long, high long, low long, bands array<long>")


def full_sets(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, size, odd, shingles): the parities of a set's numbers in ODD_BITS bins, and its distinct 64-bit hashes in ascending order, as bytes."""

    def run(batches):
        for part in arrowtext.slices(batches, text):
            words = Words(*arrowtext.column(part.column(part.schema.get_field_index(text))), arrowtext.SPACE)
            sets = distinct_sets(*shingles(words), words.rows)
            odd = [np.packbits(np.bincount((mix(s) % U(ODD_BITS)).astype(np.int64), minlength=ODD_BITS) & 1).view(np.int64) for s in sets]
            own = [pa.array([len(s) for s in sets], pa.int64()), pa.array(odd, pa.list_(pa.int64())), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(doc_id)), *own], ["node", "size", "odd", "shingles"])

    return docs.select(doc_id, text).mapInArrow(run, "node long, size long, odd array<long>, shingles binary")


def may_reach(size: str, odd: str, other_size: str, other_odd: str, percent: int):
    """Whether two sets can be linked: they differ in at least as many shingles as their sizes do, and as their parities do in bits."""
    bits = sum((F.bit_count(F.get(odd, F.lit(i)).bitwiseXOR(F.get(other_odd, F.lit(i)))) for i in range(ODD_BITS // 64)), F.lit(0))
    differ = F.greatest(bits, F.abs(F.col(size) - F.col(other_size)))
    return (100 - percent) * (F.col(size) + F.col(other_size)) >= (100 + percent) * differ


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of which 100 * intersection >= percent * union, on full sets."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # the short figures of both sides first: few pairs need their sets
    brief = lambda c: sets.select(F.col("node").alias(c), F.col("size").alias(f"{c}_size"), F.col("odd").alias(f"{c}_odd"))
    sized = pairs.select("a", "b").distinct().join(brief("a"), "a").join(brief("b"), "b")
    likely = sized.where(may_reach("a_size", "a_odd", "b_size", "b_odd", percent)).select("a", "b")
    left = likely.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of rows of sets (node, label, size, odd, shingles) with other labels among which are all that reach the threshold."""

    def bins(batches):
        count = np.zeros(COUNT_BINS, np.int64)
        for batch in batches:
            for x in batch.column(0):
                count += np.bincount((np.frombuffer(x.as_buffer(), U) % U(COUNT_BINS)).astype(np.int64), minlength=COUNT_BINS)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], ["bin", "n"])

    spark = sets.sparkSession
    counts = sets.select("shingles").mapInArrow(bins, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()  # COUNT_BINS rows at most
    weight = np.zeros(COUNT_BINS, np.int64)
    weight[counts.column(0).to_numpy()] = counts.column(1).to_numpy()
    shared = spark.sparkContext.broadcast(weight)

    def run(batches):
        for batch in batches:
            rows, marks, index = [], [], []
            for i, x in enumerate(batch.column(4)):
                own = np.frombuffer(x.as_buffer(), U)
                own = own[np.lexsort((own, shared.value[(own % U(COUNT_BINS)).astype(np.int64)]))]
                n = len(own)
                probe = n - -(-percent * n // 100) + 1
                least = n - -(-2 * percent * n // (100 + percent)) + 1  # of a set that meets none smaller
                rows.append(np.full(probe, i))
                marks.append(own[:probe].view(np.int64))
                index.append(np.arange(probe) < least)
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(4)), pa.array(np.concatenate(marks)), pa.array(np.concatenate(index))], ["node", "label", "size", "odd", "shingle", "least"])

    marks = sets.select("node", "label", "size", "odd", "shingles").mapInArrow(run, "node long, label long, size long, odd array<long>, shingle long, least boolean")
    marks = Workspace(spark, "prefixes").write(marks, "marks")
    shared.unpersist()
    lower = marks.where("least").select(F.col("node").alias("other"), F.col("label").alias("other_label"), F.col("size").alias("other_size"), F.col("odd").alias("other_odd"), "shingle")
    # the one with fewer shingles, or of as many the lesser one, is found by its least prefix
    order = (F.col("other_size") < F.col("size")) | ((F.col("other_size") == F.col("size")) & (F.col("other") < F.col("node")))
    on = (marks["shingle"] == lower["shingle"]) & (F.col("label") != F.col("other_label")) & order & may_reach("size", "odd", "other_size", "other_odd", percent)
    return marks.join(lower, on).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs."""
    work = Workspace(docs.sparkSession, "minhash")
    signed = work.write(signatures(docs, doc_id, text), "signed")
    texts = signed.where("n_shingles > 0 and doc_id is not null")
    classes = work.write(texts.groupBy("high", "low").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("size"), F.first("bands").alias("bands")), "classes")

    bands = classes.select("node", F.explode("bands").alias("band"))
    hubs = [F.min(F.struct(F.xxhash64("node", F.lit(j)), "node"))["node"].alias(f"hub{j}") for j in range(1, HUBS + 1)]
    buckets = bands.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("hub"), *hubs).where("n > 1")
    several = F.when(F.col("n") > 2, F.array(*(f"hub{j}" for j in range(1, HUBS + 1))))
    buckets = work.write(buckets.select("band", "hub", several.alias("hubs")), "buckets")
    members = work.write(bands.join(buckets.select("band", "hub"), "band").select("band", "node", "hub"), "members")

    # a class's set comes from the text of the row that names it; other rows of that doc_id must not stand for it
    named = members.select("node").distinct().withColumnRenamed("node", "doc_id")
    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(work.write(named, "named"), "doc_id", "left_semi")
    sets = work.write(full_sets(wanted, "doc_id", "text"), "sets", codec="uncompressed")

    first = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    # one doc_id with several texts is one document: it links its classes
    repeated = texts.groupBy("doc_id").agg(F.min("high").alias("least"), F.max("high").alias("most"), F.min("low").alias("low"), F.max("low").alias("high")).where("least <> most or low <> high").select("doc_id")
    own = texts.join(repeated, "doc_id").join(classes.select("high", "low", "node"), ["high", "low"]).select("doc_id", "node")
    same = own.groupBy("doc_id").agg(F.min("node").alias("a")).join(own, "doc_id").where("a <> node").select("a", F.col("node").alias("b"))
    links = work.write(verified(first, sets, percent).union(same), "links-0")
    labels = components(links, work, "first")

    def labelled(rows: DataFrame, column: str, to: str) -> DataFrame:
        own = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        return rows.join(own, rows[column] == own["_n"], "left").withColumn(to, F.coalesce("_l", column)).drop("_n", "_l")

    def outside() -> DataFrame:
        """Classes not linked to their bucket's least class."""
        return labelled(labelled(members, "node", "label"), "hub", "hub_label").where("label <> hub_label").select("band", "node", "label")

    more = outside().join(buckets.where("hubs is not null").select("band", "hubs"), "band").select("node", "label", F.explode("hubs").alias("other")).distinct()
    more = labelled(more, "other", "other_label").where("label <> other_label").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    fresh = work.write(verified(more, sets, percent), "links-1")
    if not fresh.isEmpty():
        links = links.union(fresh)
        labels = components(links, work, "second")

    open_ = labelled(members.join(outside().select("band").distinct(), "band", "left_semi").select("node").distinct(), "node", "label")
    pairs = prefix_pairs(sets.join(open_, "node"), percent)
    fresh = work.write(verified(pairs, sets, percent), "links-2")
    if not fresh.isEmpty():
        labels = components(links.union(fresh), work, "third")

    class_of = work.write(labelled(classes.select("high", "low", "size", "node"), "node", "component").select("high", "low", F.col("size").alias("n_shingles"), "component"), "components")
    joined = signed.select("doc_id", "n_shingles", "high", "low").withColumn("high", F.coalesce("high", F.xxhash64("doc_id", F.rand(7)))).join(class_of, ["high", "low", "n_shingles"], "left")
    component = F.coalesce("component", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
