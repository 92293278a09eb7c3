import math
import random
import re

import numpy as np
import pyarrow as pa
from lakegauge.llm import language_id, sentence_spans

SF = "/root/testdata/sf0.01"
RUN, MIN_WORDS = sentence_spans.RUN, sentence_spans.MIN_WORDS


def sentences(text):
    """(first byte, words) of each sentence."""
    raw, out, fresh, last = text.encode(), [], True, 0
    for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw):
        if fresh or re.search(rb"[\r\n]", raw[last : m.start()]):
            out.append((m.start(), []))
        out[-1][1].append(m[0].lower() if m[0].isascii() else re.sub(rb"[A-Z]", lambda x: x[0].lower(), m[0]))
        fresh, last = m[0][-1:] in (b".", b"!", b"?"), m.end()
    return out


def shortest(own):
    """The shortest runs from and up to each sentence that are long enough, sentences of over 50 words, and the whole."""
    least, n, found = min(RUN, len(own)), len(own), set()
    size = [len(s[1]) for s in own]
    for a in range(n):
        b, words = a, 0
        while b < n and (words < MIN_WORDS or b - a < least):
            words += size[b]
            b += 1
        if words >= MIN_WORDS and b - a >= least:
            found.add((a, b))
        b, words = a, 0  # backwards, up to sentence a
        while b >= 0 and (words < MIN_WORDS or a + 1 - (b + 1) < least):
            words += size[b]
            b -= 1
        if words >= MIN_WORDS and a - b >= least:
            found.add((b + 1, a + 1))
        if size[a] > 50:
            found.add((a, a + 1))
    return found | ({(0, n)} if n >= RUN else set())


def brute(rows):
    runs, found = {}, {}
    for i, text in rows:
        own = sentences(text or "")
        for a, b in shortest(own):
            runs.setdefault(tuple(w for s in own[a:b] for w in s[1]), []).append((i, a, b))
    gone = {i: set() for i, _ in rows}
    for places in runs.values():
        for i, a, b in sorted(places)[1:]:
            gone[i].update(range(a, b))
    for i, text in rows:
        own, raw = sentences(text or ""), (text or "").encode()
        ends = [s[0] for s in own[1:]] + [len(raw)]
        kept = (raw[: own[0][0]] if own else raw) + b"".join(raw[s[0] : e] for k, (s, e) in enumerate(zip(own, ends)) if k not in gone[i])
        found[i] = (None if text is None else kept.decode(), len(own), len(gone[i]))
    return found


def compare(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cuts", language_id.held_out())
    got = {r["doc_id"]: (r["text"], r["n_sentences"], r["n_removed"]) for r in sentence_spans.remove_repeats(docs).collect()}
    assert got == brute(rows)


def test_repeats_of_documents(spark):
    compare(spark, [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()])


def test_repeats_of_odd_rows(spark):
    rng = random.Random(2)
    passage = " ".join(f"Word{i} is the {i} of all these." for i in range(9))
    rows = [(9 - i, " ".join(f"S{rng.random()} goes here." for _ in range(5)) + " " + passage + " Then x.") for i in range(5)]
    rows += [(20, None), (21, ""), (22, " \n "), (23, passage + "\n" + passage), (24, "one " * 30), (25, "one " * 30), (26, passage.upper()), (27, "A. B. C. D."), (28, "A. B. C. D."), (29, passage.replace(" ", "  ")), (30, ". ".join(f"t{i}" for i in range(30000)))]
    compare(spark, rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sentence_spans.remove_repeats(empty).collect() == []
    twice = spark.createDataFrame([(None, passage), (3, passage), (3, passage)], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["n_removed"] > 0) for r in sentence_spans.remove_repeats(twice).collect()) == [(0, True), (3, False), (3, False)]


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = language_id.held_out()
    found = language_id.predict(docs.select("doc_id", "text", "lang", held.alias("held")), language_id.fit(docs.where(~held))).where("held").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.98 * len(found) > 100
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_odd_rows(spark):
    rows = [(1, "the and of with", "en"), (2, "der die und das", "de"), (3, None, "en"), (4, "", None), (5, "123 --- !", "de"), (6, "é" * 30000, None), (None, "the of and", None), (1, "the and of with", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.predict(docs, language_id.fit(docs)).collect()
    assert [r["lang_pred"] for r in found[:6]][:2] == ["en", "de"] and [r["lang_pred"] for r in found[2:5]] == ["und"] * 3
    assert len(found) == 8 and found[0] == found[7] and found[4]["score"] == 0
    none = language_id.predict(docs, language_id.fit(docs.where("lang is null"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
    assert language_id.predict(docs.limit(0), language_id.fit(docs)).collect() == []


def every(rows):
    """Texts without each sentence that lies in a run of RUN sentences and MIN_WORDS words or more, or is of over 50 words, or in a whole document of RUN sentences, that stands earlier too; all runs are tried."""
    runs, found = {}, {}
    for i, text in rows:
        own = sentences(text)
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                words = tuple(w for s in own[a:b] for w in s[1])
                if len(words) > 50 or len(words) >= MIN_WORDS and b - a >= min(RUN, len(own)) or b - a == len(own) >= RUN:
                    runs.setdefault(words, []).append((i, a, b))
    gone = {i: set() for i, _ in rows}
    for places in runs.values():
        for i, a, b in sorted(places)[1:]:
            gone[i].update(range(a, b))
    for i, text in rows:
        own = sentences(text)
        ends = [s[0] for s in own[1:]] + [len(text.encode())]
        found[i] = b"".join(text.encode()[s[0] : e] for k, (s, e) in enumerate(zip(own, ends)) if k not in gone[i]).decode()
    return found


def test_every_run_of_a_passage_is_found(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(10**9)}"
    sentence = lambda n: " ".join(word() for _ in range(n)) + "."
    passages = [[sentence(n) for n in sizes] for sizes in ([60], [50], [51], [30, 3], [3, 30, 3], [9, 4, 9], [9, 9], [5, 5, 5, 5, 5, 5, 2, 1], [25, 25, 4, 4])]
    rows = []
    for i in range(120):
        parts = [sentence(rng.randrange(1, 15)) for _ in range(rng.randrange(3))] + rng.choice(passages) + [sentence(rng.randrange(1, 15)) for _ in range(rng.randrange(3))]
        rows.append((i, " ".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = every(rows)
    got = {r["doc_id"]: r["text"] for r in sentence_spans.remove_repeats(docs).collect()}
    assert got == want
    assert sentence_spans.remove_repeats(docs.limit(0)).collect() == []


def test_short_documents_that_are_copies(spark):
    short = "It was so. It is. It will be."
    rows = [(1, short), (2, short.upper()), (3, "Before it. " + short + " After."), (4, "One alone."), (5, "One alone."), (6, short + " More.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in sentence_spans.remove_repeats(docs).collect()}
    assert got == {**dict(rows), 2: ""}


def test_more_languages_than_landmarks_and_long_texts(spark):
    """Seventy languages of two words each, some with long texts only; each is learned."""
    rng, rows = random.Random(6), []
    letters = [chr(c) for c in range(0x561, 0x587)] + [chr(c) for c in range(0x430, 0x450)]
    for n in range(70):
        own = ["".join(rng.choice(letters) for _ in range(6)) for _ in range(3)]
        for k in range(8):
            rows.append((len(rows), " ".join(rng.choice(own) for _ in range(4000 if n % 9 == 0 else 12)), f"l{n:02d}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs.where("doc_id % 8 <> 0"))
    assert len(model.languages) == 70
    found = language_id.predict(docs.where("doc_id % 8 = 0"), model).collect()
    assert len(found) == 70 and sum(r["lang"] == r["lang_pred"] for r in found) >= 69


def kernel(a, b):
    """The share of byte n-grams of 1 to 3 bytes that two texts have both, over the geometric mean of their numbers, by bucket."""
    def grams(t):
        low = "".join(c.lower() if c.isascii() or 0xC0 <= ord(c) <= 0xDE and ord(c) != 0xD7 else c for c in t).encode()
        return {((int.from_bytes(low[i : i + k], "big") + (k << 24)) * 0x9E3779B1 & 0xFFFFFFFF) >> 19 for k in (1, 2, 3) for i in range(len(low) - k + 1)}

    x, y = grams(a), grams(b)
    return len(x & y) / math.sqrt(len(x) * len(y))


def test_scores_equal_plain_kernel_ridge_regression(spark):
    """With every row a landmark the scores are those of ridge regression on the kernel's own feature space."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang is not null and length(text) < 900").select("text", "lang").distinct().orderBy("text").limit(40).collect()]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = language_id.fit(docs)
    got = model.scores(pa.array([t for t, _ in rows]))
    k = np.array([[kernel(a, b) for b, _ in rows] for a, _ in rows])
    values, vectors = np.linalg.eigh(k)
    kept = values > 1e-6 * values.max()
    phi = np.hstack([vectors[:, kept] * np.sqrt(values[kept]), np.ones((len(rows), 1))])
    names = sorted({l for _, l in rows})
    weight = np.array([1 / sum(x == l for _, x in rows) for _, l in rows])[:, None]
    target = np.array([[1.0 if l == n else -1.0 for n in names] for _, l in rows])
    gram = phi.T @ (phi * weight)
    want = phi @ np.linalg.solve(gram + language_id.RIDGE * np.trace(gram) / len(gram) * np.eye(len(gram)), phi.T @ (target * weight))
    assert model.languages == names and np.abs(got - want).max() < 2e-3
