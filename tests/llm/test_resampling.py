import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from lakegauge.llm import resampling as rs
from pyspark.sql import functions as F


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def features(text, longest=1, buckets=10_000):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, percent=10, least=20, longest=1):
    """(doc_id, n_features, weight, score, rank) of all rows, in order."""
    s, t = (Counter(b for x in texts for b in features(x, longest)) for texts in ([x for _, x in rows], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in s}
    out = []
    for doc_id, text in rows:
        found = features(text, longest)
        weight, score = sum(gain[b] for b in found), None
        if doc_id is not None:
            h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None])
    eligible = [i for i, (doc_id, text) in enumerate(rows) if doc_id is not None and len(words(text)) >= least]
    for rank, i in enumerate(sorted(eligible, key=lambda i: (-out[i][3], rows[i][0]))[: percent * len(eligible) // 100]):
        out[i][4] = rank + 1
    return sorted(map(tuple, out), key=str)


def corpus(seed, n=400):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(["Alpha", "beta", "gámma", "delta9", "x" * 90, "łódź"]) + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 60)))) for i in range(n)]
    rows += [(None, "null id " * 20), (None, None), (n, None), (n + 1, ""), (n + 2, "!? ..."), (n + 3, "longer " * 30_000)]
    rows += [(n + 4, "the same text again and again " * 9)] * 6  # rows that repeat
    return rows, [rows[i][1] for i in range(0, 40)]


def found(spark, rows, target, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rank": F.lit("x"), "Weight": F.lit("y"), "run": F.lit(1)})
    return sorted((tuple(r) for r in rs.resample(docs.repartition(7), spark.createDataFrame([(t,) for t in target], "text string"), **options).collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"percent": 35}, {"percent": 100}, {"percent": 0}, {"least_words": 1, "longest": 3}])
def test_against_a_plain_sort(spark, options):
    rows, target = corpus(1)
    least = options.get("least_words", 20)
    assert found(spark, rows, target, **options) == brute(rows, target, options.get("percent", 10), least, options.get("longest", 1))


@pytest.mark.parametrize("range_rows", [1, 16, 90])
def test_runs_cut_into_ranges(spark, monkeypatch, range_rows):
    monkeypatch.setattr(rs, "RANGE_ROWS", range_rows)
    rows, target = corpus(2)
    for percent in (10, 55, 100):
        assert found(spark, rows, target, percent=percent) == brute(rows, target, percent)


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(rs, "RANGE_ROWS", 32)
    scored = spark.range(1000).select((999 - F.col("id")).alias("doc_id"), F.lit(30).cast("long").alias("n_words"), F.lit(30).cast("long").alias("n_features"), F.lit(5).cast("long").alias("weight"), (F.col("id") % 2 + 7).alias("score"))
    got = {r["doc_id"]: r["rank"] for r in rs.draw(scored.repartition(9), percent=60).collect()}
    order = [i for s in (8, 7) for i in range(1000) if (999 - i) % 2 + 7 == s]
    assert got == {i: r + 1 if r < 600 else None for r, i in enumerate(order)}


def test_only_ranges_of_the_draw_are_merged(spark, monkeypatch):
    seen = []
    merged = rs._merged
    monkeypatch.setattr(rs, "RANGE_ROWS", 16)
    monkeypatch.setattr(rs, "_merged", lambda blocks, *a: seen.append((blocks.agg(F.sum("n")).first()[0], a[2])) or merged(blocks, *a))
    rows, target = corpus(3)
    found(spark, rows, target, percent=10)
    (read, wanted), = seen
    assert wanted <= read < 3 * wanted + 64


def test_empty_tables(spark):
    assert found(spark, [], ["a target"]) == []
    rows, _ = corpus(4, 30)
    assert found(spark, rows, []) == brute(rows, [])
    assert found(spark, rows, [None, ""]) == brute(rows, [])


@pytest.mark.parametrize("runs", [1, 2, 3, 8, 13])
def test_tournament_of_runs(runs):
    rng = random.Random(runs)
    lists = [sorted((rng.randint(0, 30), i, j) for j in range(rng.randint(0, 20))) for i in range(runs)]
    tree, out = rs.Tournament(runs), []
    iterators = [iter(x) for x in lists]
    for i, it in enumerate(iterators):
        tree.put(i, next(it, tree.NONE))
    while (head := tree.least())[1] is not tree.NONE:
        out.append(head[1])
        tree.put(head[0], next(iterators[head[0]], tree.NONE))
    assert out == sorted(x for part in lists for x in part)
