import random
import re
from collections import defaultdict

import numpy as np
from lakegauge.llm import minhash_fss

SF = "/root/testdata/sf0.01"


def brute(rows, percent=85):
    """(doc_id -> component, number of shingles by row) over all pairs that share a shingle."""
    sets, found = [], []
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            index[g].append(i)
    seen = {(a, b) for g in index.values() for k, a in enumerate(g) for b in g[k + 1 :]}
    for a, b in seen:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = root(rows[a][0]), root(rows[b][0])
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in rows}, [len(s) for s in sets]


def compare(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(tuple(r) for r in minhash_fss.near_duplicates(docs).collect())
    component, size = brute(rows)
    assert found == sorted((i, n, component[i], component[i] == i) for (i, _), n in zip(rows, size))


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    compare(spark, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_groups_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(len(words))] = f"x{rng.random()}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(2000 + i, " ".join(base[: 150 + i * 5])) for i in range(30)]
    for i in range(120):  # some of these link to few others, most to none
        words = list(base)
        for _ in range(rng.randrange(4, 16)):
            words[rng.randrange(len(words))] = f"y{rng.random()}"
        rows.append((3000 + i, " ".join(words)))
    compare(spark, rows)


def test_odd_rows(spark):
    long = " ".join(f"t{i % 977}{i}" for i in range(60000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One TWO"), (6, "one two three four five"), (7, "one two three four"), (8, long), (9, long + " end"), (4, "one two"), (10, "one\x0btwo")]
    compare(spark, rows)
    docs = spark.createDataFrame([(None, "a b c", "x"), (3, "a b c", None), (5, "A b c", "y"), (None, None, None)], "doc_id long, text string, component_id string")
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash_fss.near_duplicates(docs).collect()} == {(None, 3, True), (None, None, True), (3, 3, True), (5, 3, False)}
    assert minhash_fss.near_duplicates(docs.limit(0)).count() == 0
    # one document with two texts links the groups of both
    compare_two = spark.createDataFrame([(9, "q r s t u"), (2, "a b c d e"), (5, "a b c d e"), (5, "q r s t u")], "doc_id long, text string")
    assert {r["component_id"] for r in minhash_fss.near_duplicates(compare_two).collect()} == {2}


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    common, own = rng.integers(0, 2**63, 900, dtype=np.uint64), rng.integers(0, 2**63, 100, dtype=np.uint64)
    sets = [common, np.concatenate([common, own]), common[:1]]
    bins = minhash_fss.sketches(np.concatenate(sets), np.repeat([0, 1, 2], [len(s) for s in sets]), 3, 2000)
    assert (bins != np.uint64(2**64 - 1)).all()
    assert abs((bins[0] == bins[1]).mean() - 0.9) < 0.03


def test_a_template_that_many_share_makes_few_pairs(spark):
    """600 texts of one template and a tenth of their own are below the threshold, all in one bucket's reach, and are not compared pair by pair."""
    rng = random.Random(9)
    template = [f"t{i}" for i in range(270)]
    rows = [(i, " ".join(template + [f"u{i}x{k}" for k in range(60)])) for i in range(600)]
    rows += [(1000 + i, " ".join(template + [f"v{i // 2}x{k}" for k in range(60)] + [f"w{rng.random()}"] * (i % 2))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = minhash_fss.full_sets(docs, "doc_id", "text").withColumn("label", minhash_fss.F.col("node"))
    pairs = {(r["a"], r["b"]) for r in minhash_fss.prefix_pairs(sets, 85).collect()}
    assert {(1000 + 2 * i, 1001 + 2 * i) for i in range(10)} <= pairs and len(pairs) < 100
    component, size = brute(rows)
    found = {r["doc_id"]: r["component_id"] for r in minhash_fss.near_duplicates(docs).collect()}
    assert found == component
