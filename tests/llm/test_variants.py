import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from lakegauge.llm import spelling_variants as sv
from lakegauge.llm.crc import crc32
from lakegauge.llm.workspace import Workspace
from pyspark.sql import functions as F


def counted(docs, least=7, least_count=2, one_in=31):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % one_in == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least and n >= least_count}


def one_edit(a, b):
    """By trying every edit of the longer word."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(words, times=10):
    out, form = {}, {}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def found(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def corpus(seed, n=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcéÿ") for _ in range(rng.randint(7, 11))) for _ in range(25)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 60)):
            w = stems[min(int(rng.expovariate(0.3)), 24)]
            if rng.random() < 0.2:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + "b" + w[k:], w[:k] + "c" + w[k + 1 :], w.upper(), w.title()])
            words.append(w)
        rows.append((i, rng.choice([" ", "-", "3 ", "ł", "× "]).join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_words_and_groups_against_all_pairs(spark, seed):
    rows = corpus(seed) + [(None, "Wordlike wordlike wordlikes"), (500, None), (501, ""), (501, "wordlike " * 40), (501, "wordlike " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(sv.variants(docs.withColumns({"word": F.lit("x"), "n": F.lit(1)}).repartition(5)))
    assert got == grouped(counted(rows))
    assert any(form for form, *_ in got.values()) and any(r[3] > 3 for r in got.values())


def test_every_occurrence_can_be_garbled(spark):
    rows = corpus(9) + [(7, "ÉÉABCDEFG ééabcdefg")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: r[1] for r in sv.word_counts(docs, one_in=1, least=3, least_count=1).collect()}
    assert got == counted(rows, least=3, least_count=1, one_in=1)


def test_hot_segments_meet_once_over_a_grid(spark):
    rng = random.Random(4)
    words = {"prefix" + "".join(rng.choice("ab") for _ in range(rng.randint(5, 8))): rng.randint(2, 400) for _ in range(300)}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randint(4, 7))) + "suffixed": rng.randint(2, 400) for _ in range(200)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    want = {w: (len(near), min((-words[v], v) for v in near)) for w in words if (near := [v for v in words if one_edit(w, v)])}
    for limits in ({}, {"shard_words": 7, "shard_scans": 11}, {"shard_words": 10_000, "shard_scans": 5}):
        got = {r["word"]: (r["n_near"], (-r["best_n"], r["best"])) for r in sv.neighbours(table, **limits).collect()}
        assert got == want, limits


def test_long_words(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcd") for _ in range(n)) for n in (126, 127, 128, 129, 130, 131, 200, 40_000)]
    words = set(base)
    for w in base:
        for _ in range(6):
            k = rng.randrange(len(w))
            words |= {w[:k] + w[k + 1 :], w[:k] + "e" + w[k:], w[:k] + "f" + w[k + 1 :]}
    counts = {w: i % 50 + 2 for i, w in enumerate(sorted(words))}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words if len(w) < 1000}
    got = {r["word"]: r["n_near"] for r in sv.neighbours(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert {w: n for w, n in got.items() if len(w) < 1000} == {w: len(v) for w, v in near.items() if v}
    assert got[base[-1]] == sum(len(w) > 1000 for w in words) - 1


def test_chains_of_forms_lead_to_the_last(spark):
    chain = [("abcdefgh"[:7] + "x" * i, 2 * 10**i) for i in range(18)]
    forms = spark.createDataFrame([(a, b) for (a, _), (b, _) in zip(chain, chain[1:])] + [(f"alone{i}", chain[3][0]) for i in range(50)], "word string, form string")
    got = sv.roots(forms, Workspace(spark, "test")).collect()
    assert len(got) == 67 and {r["root"] for r in got} == {chain[-1][0]}


def test_empty_tables_and_no_words(spark):
    for rows in ([], [(1, None), (2, ""), (3, "short wörds 1234567")]):
        assert found(sv.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == {}


def test_crc_of_spans():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    start = rng.integers(0, 4900, 300)
    end = start + rng.integers(0, 100, 300)
    begin = rng.integers(0, 2**32, 300, dtype=np.uint32)
    assert crc32(data, start, end).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(start, end)]
    assert crc32(data, start, end, begin).tolist() == [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(start, end, begin)]
