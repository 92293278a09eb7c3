"""Language of a text by a string kernel: n-gram presence, Nystrom landmarks, ridge regression.

The blended-spectrum presence kernel of two texts is the number of byte n-grams of 1 to 3 bytes
(letters lower-cased; n-grams hashed to BUCKETS) that both have, over the geometric mean of their
numbers. Training texts, LANDMARKS in all or LEAST a language if that is more, span a Nystrom feature
space; in it a ridge regression for each language against the rest is solved in closed form. Both
fitting and scoring multiply batches of presence vectors by one matrix.

Fitting uses a bounded sample of the labelled training rows, at most PER_LANGUAGE for each
language, chosen by a hash of the text alone; every language and texts of every length take part.
Tasks make the sample's presence vectors, of BUCKETS bits each, and one task fits the model from sums over
these, so what meets there does not grow with the texts. Scoring covers every whole text.

Defined results: null text and text without letters is UNKNOWN with score 0; without any labelled
rows that have letters there is no model and all texts are UNKNOWN; equal texts have equal results
(of texts with several labels each label learns); extra columns pass through, but for ones named as
those made here.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrowtext
from .arrowtext import U
from .workspace import Workspace, ddl, prepare, small, without

UNKNOWN = "und"
LENGTHS = (1, 2, 3)
BUCKETS = 1 << 13
LANDMARKS, LEAST = 192, 4
PER_LANGUAGE = 400
RIDGE = 1e-2
#: Rows of a presence matrix at a time.
BATCH = 128


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row for each text: 1 in the buckets of its n-grams."""
    n = len(offsets) - 1
    out = np.zeros((n, BUCKETS), np.float32)
    if not len(data):
        return out
    low = arrowtext.LOWER[data].copy()
    # upper case of two-byte Latin letters, C3 80 to C3 9E but for the times sign
    second = np.flatnonzero((low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97) & (low[:-1] == 0xC3)) + 1
    low[second] += 0x20
    row = np.repeat(np.arange(n, dtype=np.int64) * BUCKETS, np.diff(offsets))
    flat = out.ravel()
    gram = np.zeros(len(low), np.uint32)
    for k in LENGTHS:
        gram = (gram[:-1] << np.uint32(8) | low[k - 1 :]) if k > 1 else low.astype(np.uint32)
        same = row[: len(gram)] == row[k - 1 :]
        bucket = ((gram + np.uint32(k << 24)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        flat[(row[: len(gram)] + bucket)[same]] = 1
    return out


def _has_letter(texts: list) -> np.ndarray:
    return np.array([any(map(str.isalpha, t)) if t else False for t in texts], bool)


class Model:
    """languages in order; weights and bias: presence vectors (each over its norm) to one score a language."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray):
        self.languages, self.weights, self.bias = languages, weights, bias

    def scores(self, array) -> np.ndarray:
        """A row of scores for each text."""
        return _unit(array) @ self.weights + self.bias

    def predict(self, array) -> tuple[list[str], np.ndarray]:
        scores = self.scores(array)
        best = scores.argmax(axis=1)
        odds = np.exp(3 * (scores - scores.max(axis=1, keepdims=True)))
        return [self.languages[b] for b in best], 1 / odds.sum(axis=1, dtype=np.float64)


def _unit(array) -> np.ndarray:
    return _normed(presence(*arrowtext.column(array)))


def _normed(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt(np.maximum(raw.sum(axis=1, keepdims=True), 1))


def solve(parts) -> Model | None:
    """The model of (unit vectors, labels, whether they are landmarks) parts; the vectors of the first labels of each language, as many as LEAST or its share, must come first."""
    landmarks, project, sums, counts = [], None, {}, {}

    def add(unit, labels):
        features = np.hstack([unit.astype(np.float64) @ project, np.ones((len(labels), 1))])
        for name in sorted(set(labels)):
            own = features[[x == name for x in labels]]
            # each language weighs the same, so its sums are kept apart
            gram, total = sums.get(name, (0.0, 0.0))
            sums[name], counts[name] = (gram + own.T @ own, total + own.sum(axis=0)), counts.get(name, 0) + len(own)

    held = []
    for unit, labels, landmark in parts:
        if project is None and landmark:
            landmarks.append(unit)
            held.append((unit, labels))
            continue
        if project is None:
            project = _projection(np.concatenate(landmarks or [unit]))
            for x in held:
                add(*x)
        add(unit, labels)
    if project is None and landmarks:
        project = _projection(np.concatenate(landmarks))
        for x in held:
            add(*x)
    if not sums:
        return None
    names = sorted(sums)
    gram = sum(sums[x][0] / counts[x] for x in names)
    mean = {x: sums[x][1] / counts[x] for x in names}
    target = np.stack([2 * mean[x] - sum(mean.values()) for x in names], axis=1)
    solved = np.linalg.solve(gram + RIDGE * np.trace(gram) / len(gram) * np.eye(len(gram)), target)
    return Model(names, (project @ solved[:-1]).astype(np.float32), solved[-1].astype(np.float32))


def _projection(landmarks: np.ndarray) -> np.ndarray:
    """Presence vectors to the space that the landmarks span, by the inverse root of their kernel."""
    landmarks = landmarks.astype(np.float64)
    values, vectors = np.linalg.eigh(landmarks @ landmarks.T)
    kept = values > 1e-6 * values.max(initial=1)
    return landmarks.T @ (vectors[:, kept] / np.sqrt(values[kept]))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """A model of the labelled rows; None if there are none. A task holds the sums, and the driver the solved weights only."""
    spark = labelled.sparkSession
    work = Workspace(spark, "language-id")
    place = F.xxhash64(text).bitwiseAND(F.lit((1 << 53) - 1))
    rows = labelled.where(F.col(lang).isNotNull() & (F.octet_length(text) > 0)).select(F.col(lang).alias("lang"), place.alias("place"), F.col(text).alias("text"))
    places = work.write(rows.groupBy("lang", "place").agg(F.lit(1).alias("one")).select("lang", "place"), "places")
    # places are even, so twice the share that is wanted holds the least ones, and few rows of a language meet in its window
    share = places.groupBy("lang").agg((F.lit(2.0 * PER_LANGUAGE) / F.count("*")).alias("share"))
    near = places.join(share, "lang").where(F.col("place") <= F.col("share") * float(1 << 53))
    ranked = near.select("lang", "place", F.row_number().over(Window.partitionBy("lang").orderBy("place")).alias("rank"))
    chosen = work.write(ranked.where(F.col("rank") <= PER_LANGUAGE), "chosen")
    languages = chosen.where("rank = 1").count()
    first = max(LEAST, LANDMARKS // max(1, languages))
    sample = rows.join(small(chosen), ["lang", "place"]).groupBy("lang", "place", "rank").agg(F.min("text").alias("text"))
    sample = work.write(sample.select("lang", "text", "rank", (F.col("rank") <= first).alias("landmark")), "sample")

    def vectors(batches):
        for whole in arrowtext.slices(batches, "text"):
            for lo in range(0, whole.num_rows, BATCH):
                part = whole.slice(lo, BATCH)
                part = part.filter(pa.array(_has_letter(part.column(1).to_pylist())))
                if part.num_rows:
                    bits = np.packbits(presence(*arrowtext.column(part.column(1))).astype(bool), axis=1)
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([b.tobytes() for b in bits], pa.binary()), *(part.column(i) for i in (2, 3))], ["lang", "bits", "rank", "landmark"])

    def run(batches):
        def parts():
            for whole in batches:
                for lo in range(0, whole.num_rows, BATCH):
                    part = whole.slice(lo, BATCH)
                    cut = sum(part.column(2).to_pylist())  # landmarks come first
                    for x in (part.slice(0, cut), part.slice(cut)):
                        if x.num_rows:
                            raw = np.stack([np.unpackbits(np.frombuffer(b, np.uint8)) for b in x.column(1).to_pylist()]).astype(np.float32)
                            yield _normed(raw), x.column(0).to_pylist(), x.column(2)[0].as_py()

        if model := solve(parts()):
            yield pa.RecordBatch.from_pylist([{"languages": model.languages, "weights": model.weights.tobytes(), "bias": model.bias.tobytes()}], _SOLVED)

    seen = sample.select("lang", "text", "rank", "landmark").mapInArrow(vectors, "lang string, bits binary, rank int, landmark boolean")
    ordered = seen.repartition(1).sortWithinPartitions(F.desc("landmark"), "lang", "rank").select("lang", "bits", "landmark")  # BUCKETS bits a row
    found = ordered.mapInArrow(run, "languages array<string>, weights binary, bias binary").collect()  # one row: BUCKETS numbers a language
    if not found:
        return None
    r = found[0]
    return Model(list(r["languages"]), np.frombuffer(r["weights"], np.float32).reshape(BUCKETS, -1), np.frombuffer(r["bias"], np.float32))


_SOLVED = pa.schema([("languages", pa.list_(pa.string())), ("weights", pa.binary()), ("bias", pa.binary())])


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with lang_pred and score, the softmax weight of the best language."""
    spark, docs = docs.sparkSession, without(docs, "lang_pred", "score")
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS numbers a language
    schema = f"{ddl(docs)}, lang_pred string, score double"

    def run(batches):
        for whole in arrowtext.slices(batches, text):
            for lo in range(0, whole.num_rows, BATCH):
                part = whole.slice(lo, BATCH)
                column = part.column(part.schema.get_field_index(text))
                letters = _has_letter(column.to_pylist())
                if shared.value is None:
                    names, scores, letters = [UNKNOWN] * len(letters), np.zeros(len(letters)), letters & False
                else:
                    names, scores = shared.value.predict(column)
                names = [n if l else UNKNOWN for n, l in zip(names, letters)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(np.where(letters, scores, 0.0))], [*part.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """True for the quarter of documents that no fitting sees."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
