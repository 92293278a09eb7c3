import math
import pickle
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from lakegauge.llm import hpy_lm

SF = "/root/testdata/sf0.001"


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def check(spark, rows, model=None):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, word int")
    model = model or hpy_lm.train(docs.where(~hpy_lm.held_out()))
    found = hpy_lm.score(docs, model, ["doc_id"]).collect()
    counts = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((len(words(t)), sum(counts[w] > 0 for w in words(t)), round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t)), 5)) for _, t in rows)
    assert sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 5)) for r in found) == [(a, b, pytest.approx(c, abs=1e-4)) for a, b, c in want]
    assert {r["train_tokens"] for r in found} <= {n} and all(r["score"] <= 0 for r in found)
    return docs, model, found


def table_of(model):
    """word -> its row, as an Arrow batch for probability()."""
    whole = model.table.orderBy("word").toArrow().combine_chunks()
    batch = whole.to_batches()[0] if whole.num_rows else None
    return batch.column(0).to_numpy(), batch.drop_columns(["word"])


def unseen(batch):
    return pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in batch.schema], schema=batch.schema)


def test_counts_base_and_probabilities_that_sum_to_one(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs, model, found = check(spark, rows)
    # over all words of a restaurant and one for the others, probabilities sum to one
    words, batch = table_of(model)
    assert len(model.totals.own) > 20
    for place in (0, 1, 17, model.totals.root - 1, model.totals.root):
        total = hpy_lm.probability(batch, np.arange(len(words)), np.full(len(words), place), model.totals).sum()
        total += hpy_lm.probability(unseen(batch), np.zeros(1, int), np.array([place]), model.totals)[0]
        assert total == pytest.approx(1, abs=1e-9)
    scored = hpy_lm.score(docs, model, ["doc_id"])
    one = hpy_lm.perplexity(scored.where(hpy_lm.held_out())).collect()[0]
    assert one["perplexity"] < 0.8 * one["base_perplexity"]


def test_frequent_and_rare_words_score_alike(spark, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    docs, model, found = check(spark, rows)
    monkeypatch.setattr(hpy_lm, "HEAD_WORDS", 50)
    few = hpy_lm.train(docs.repartition(7).where(~hpy_lm.held_out()))
    assert 0 < len(few.scores()[0]) <= 50 < len(model.scores()[0])
    again = check(spark, rows, few)[2]
    key = lambda r: r["doc_id"]
    for a, b in zip(sorted(found, key=key), sorted(again, key=key)):
        assert a["score"] == pytest.approx(b["score"], rel=1e-5)


def test_the_driver_gets_few_bytes_and_all_scores(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    model = hpy_lm.train(spark.createDataFrame(rows, "doc_id long, text string"))
    head, scores = model.scores()
    words, batch = table_of(model)
    width = model.totals.root
    # a number for each restaurant that has the word, not for all of them
    assert len(pickle.dumps(scores)) < len(head) * width  # 4 times that as a whole array
    number, place = np.repeat(np.arange(len(head)), width), np.tile(np.arange(width), len(head))
    want = hpy_lm.probability(batch, np.searchsorted(words, head)[number], place, model.totals)
    assert np.allclose(scores(number, place), np.log10(want), rtol=1e-6, atol=0)
    common = model.common.value
    assert len(pickle.dumps(common)) <= 20 * len(common.word) + 1000  # 24 before
    p0 = {r["word"]: (r["count"], r["p0"]) for r in model.in_root().collect()}
    assert all(p0[w] == (c, p) for w, c, p in zip(common.word.tolist(), common.count.tolist(), common.p0.tolist()))


def test_rows_of_the_model_move_as_bytes(spark):
    texts = [f"{'the ' * (i % 4)}a{i % 90} b{i % 7} c{i}" for i in range(400)]
    model = hpy_lm.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    model.least = None  # all words go
    packed = model.rare_rows().toArrow().combine_chunks()
    words, batch = table_of(model)
    assert packed.num_rows <= model.buckets * model.table.rdd.getNumPartitions() < len(words)
    found, count, rows = hpy_lm._unpacked_rows(pa.RecordBatch.from_struct_array(packed.column("_model").combine_chunks()), model.count_kind)
    assert sorted(found) == words.tolist() and count[-1] == 0
    at = np.argsort(found)
    for place in range(model.totals.root + 1):
        each = np.full(len(words) + 1, place)
        got = hpy_lm.probability(rows, np.append(at, len(words)), each, model.totals)
        assert (got[:-1] == hpy_lm.probability(batch, np.arange(len(words)), each[:-1], model.totals)).all()
        assert got[-1] == hpy_lm.probability(unseen(batch), np.zeros(1, int), each[:1], model.totals)[0]


def parent(base):
    zero = np.zeros(len(base), np.int64)
    return hpy_lm.Parent(zero, zero, 0.0, 0.0 * base, base)


def test_seating_stays_in_bounds():
    n = np.array([0, 1, 2, 50, 5000, 2_000_000])
    word = np.arange(6)
    none = np.zeros(6)
    for mass in (1e-300, 0.5, 1e9):
        t = hpy_lm.seat(n, parent(np.full(6, mass)), none, 0.7, word, np.zeros(6, np.int64), 1).tables()
        assert ((t >= np.minimum(n, 1)) & (t <= n)).all()
    assert (hpy_lm.seat(n, parent(np.full(6, 1e-300)), none, 0.7, word, np.zeros(6, np.int64), 1).tables() == np.minimum(n, 1)).all()


def exact_tables(n, discount, base, others):
    """The distribution of tables of n customers of one dish, by summing over all ways to sit."""
    ways = np.zeros(n + 1)
    ways[1] = 1.0
    for m in range(1, n):
        more = np.zeros(n + 1)
        for t in range(1, m + 1):
            more[t] += ways[t] * (m - discount * t)
            more[t + 1] += ways[t] * (hpy_lm.STRENGTH + discount * (others + t)) * base
        ways = more / more.sum()
    return ways


def test_sweeps_draw_from_the_exact_distribution():
    for n, base, others in ((2, 0.3, 0), (7, 0.2, 3), (40, 0.05, 10), (300, 0.02, 40)):
        rows = 4000
        given = (parent(np.full(rows, base)), np.full(rows, float(others)), 0.6, np.arange(rows), np.zeros(rows, np.int64))
        now, counts = None, np.zeros(n + 1)
        for sweep in range(14):
            now = hpy_lm.sweep_once(now, np.full(rows, n), *given, sweep)
            if sweep >= 6:
                counts += np.bincount(now.tables(), minlength=n + 1)
        want = exact_tables(n, 0.6, base, others)
        assert np.abs(counts / counts.sum() - want).sum() < 0.06


def plain_sampler(texts, own, totals, sweeps, settle, seed=3):
    """Gibbs sampling one customer at a time, in the same tree of restaurants; returns the averaged probability as a function."""
    rng, d = random.Random(seed), totals.discounts
    root = totals.root
    up = dict.fromkeys(range(root), root)
    level = lambda p: int(p == root)
    seats, customers, tables = {}, Counter(), Counter()

    def given(p, w):
        if p is None:
            return totals.uniform
        own_ = seats.get((p, w), [])
        back = given(up.get(p), w)
        return (sum(own_) - d[level(p)] * len(own_) + (1 + d[level(p)] * tables[p]) * back) / (1 + customers[p])

    def add(p, w):
        own_ = seats.setdefault((p, w), [])
        weights = [x - d[level(p)] for x in own_] + [(1 + d[level(p)] * tables[p]) * given(up.get(p), w)]
        k = rng.choices(range(len(weights)), weights)[0]
        customers[p] += 1
        if k < len(own_):
            own_[k] += 1
        else:
            own_.append(1)
            tables[p] += 1
            if p != root:
                add(up[p], w)

    def remove(p, w):
        own_ = seats[p, w]
        k = rng.choices(range(len(own_)), own_)[0]
        own_[k] -= 1
        customers[p] -= 1
        if not own_[k]:
            own_.pop(k)
            tables[p] -= 1
            if p != root:
                remove(up[p], w)

    everyone = []
    for text in texts:
        word, place, _ = hpy_lm.tokens(pa.array([text]), own)
        everyone += list(zip(place.tolist(), word.tolist()))
    for x in everyone:
        add(*x)
    pairs = [(p, w) for p in range(root + 1) for w in sorted({w for _, w in everyone})]
    total = dict.fromkeys(pairs, 0.0)
    for sweep in range(sweeps):
        rng.shuffle(everyone)
        for x in everyone:
            remove(*x)
            add(*x)
        if sweep >= settle:
            for x in pairs:
                total[x] += given(*x) / (sweeps - settle)
    return total


def test_probabilities_agree_with_a_plain_sampler(spark, monkeypatch):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(12)]
    texts = []
    for _ in range(60):
        own = [rng.choice(vocabulary[:3])]
        for _ in range(rng.randrange(4, 12)):
            likely = [vocabulary[(vocabulary.index(own[-1]) * 2 + 1) % 12], vocabulary[0]]
            own.append(rng.choice(likely) if rng.random() < 0.6 else rng.choice(vocabulary))
        texts.append(" ".join(own))
    for name, value in (("OWN_SHARE", 12), ("SAMPLES", 24), ("SETTLE", 8), ("PASSES", 5)):
        monkeypatch.setattr(hpy_lm, name, value)
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    model = hpy_lm.train(docs)
    assert 0 < len(model.totals.own) < 12
    want = plain_sampler(texts, model.totals.own, model.totals, 260, 60)
    words, batch = table_of(model)
    away = []
    for p in sorted({p for p, _ in want}):
        ours = hpy_lm.probability(batch, np.arange(len(words)), np.full(len(words), p), model.totals)
        plain = np.array([want[p, int(w)] for w in words])
        away += np.abs(ours - plain).tolist()
    assert max(away) < 0.02 and np.mean(away) < 0.005


def test_odd_rows(spark):
    check(spark, [(1, None), (2, ""), (3, "A a B"), (3, "A a B"), (None, "é É x"), (4, " \t"), (9, "w " * 50000), (10, "z" * 100000)])
    check(spark, [(i, "x y") for i in range(40) if held(i)])
    assert check(spark, [])[2] == []


def test_columns_that_are_kept_may_have_any_name(spark):
    docs = spark.createDataFrame([(1, "a b a", "x", 2, 3), (2, None, "y", 4, 5)], "doc_id long, text string, word string, n long, n_tokens long")
    docs = docs.withColumn("odd `name", docs.word)
    model = hpy_lm.train(docs)
    found = {r["doc_id"]: r for r in hpy_lm.score(docs, model, ["doc_id", "word", "n", "n_tokens", "odd `name"][:4]).collect()}
    assert (found[1]["word"], found[1]["n"], found[1]["n_tokens"], found[2]["n_tokens"]) == ("x", 2, 4, 1)


def test_words_of_two_letters_stay_apart(spark):
    word = "".join("ab"[i.bit_count() & 1] for i in range(2048))
    check(spark, [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, word)])


def plain_restaurants(pairs, p0, discount, sweeps=3000, settle=500, seed=5):
    """Restaurants over a fixed base, one customer at a time: (context, word) -> averaged probability."""
    rng, out = random.Random(seed), {}
    for u in sorted({u for u, _ in pairs}):
        seats, everyone = {w: [] for w in p0}, [w for (v, w), n in pairs.items() if v == u for _ in range(n)]
        tables, total = 0, dict.fromkeys(p0, 0.0)
        for sweep in range(sweeps):
            for w in everyone:
                if sweep:
                    k = rng.choices(range(len(seats[w])), seats[w])[0]
                    seats[w][k] -= 1
                    if not seats[w][k]:
                        seats[w].pop(k)
                        tables -= 1
                weights = [x - discount for x in seats[w]] + [(hpy_lm.STRENGTH + discount * tables) * p0[w]]
                k = rng.choices(range(len(weights)), weights)[0]
                if k < len(seats[w]):
                    seats[w][k] += 1
                else:
                    seats[w].append(1)
                    tables += 1
            if sweep >= settle:
                for w, p in p0.items():
                    own = sum(seats[w]) - discount * len(seats[w]) + (hpy_lm.STRENGTH + discount * tables) * p
                    total[w] += own / (hpy_lm.STRENGTH + len(everyone)) / (sweeps - settle)
        out |= {(u, w): p for w, p in total.items()}
    return out


@pytest.mark.parametrize("common", [1 << 20, 6])
def test_rare_words_have_restaurants(spark, monkeypatch, common):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(80):
        own = [rng.choice(vocabulary)]
        for _ in range(12):
            own.append(vocabulary[(vocabulary.index(own[-1]) * 7 + 3) % 40] if rng.random() < 0.6 else rng.choice(vocabulary[:20]))
        texts.append(" ".join(own))
    for name, value in (("OWN_SHARE", 28), ("SAMPLES", 40), ("SETTLE", 8), ("HEAD_WORDS", 3), ("COMMON", common), ("CHUNK_ROWS", 30)):
        monkeypatch.setattr(hpy_lm, name, value)
    model = hpy_lm.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert (len(model.common.value.word) < 10) == (common == 6)
    hashed = {w: int(hpy_lm.tokens(pa.array([w]), np.zeros(0, np.int64))[0][0]) for w in [*vocabulary, "new"]}
    rare = {w for w in vocabulary if hashed[w] not in set(model.totals.own.tolist())}
    assert 25 < len(rare) < 40
    p0 = {r["word"]: r["p0"] for r in model.in_root().collect()}
    p0 = {w: p0[hashed[w]] for w in vocabulary} | {None: p0[hpy_lm.END]}
    counts = Counter((u, w) for t in texts for u, w in zip(words(t), words(t)[1:]) if u in rare)
    want = plain_restaurants(counts, p0, model.rare_discount)
    # the end after w is in the scores of both "u w" and "w"
    asked = [(u, w) for u in sorted(rare)[:8] for w in [*vocabulary[::3], "new"]]
    rows = [(i, f"{u} {w}") for i, (u, w) in enumerate(asked)] + [(1000 + i, w) for i, w in enumerate([*vocabulary, "new"])]
    found = {r["doc_id"]: r["score"] for r in hpy_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), model, ["doc_id"]).collect()}
    one = {t: found[i] for i, t in rows if i >= 1000}
    words_, batch = table_of(model)

    def known(w, place):
        rows, at = (batch, np.searchsorted(words_, [hashed[w]])) if w != "new" else (unseen(batch), np.zeros(1, int))
        return hpy_lm.probability(rows, at, np.array([place]), model.totals)[0]

    away, moved = [], []
    for i, (u, w) in enumerate(asked):
        got = 10 ** (found[i] - one[w]) * known(w, 0) / known(u, 0)
        if w == "new":
            assert got == pytest.approx(1 - sum(want[u, x] for x in p0), rel=0.1) and got < known("new", model.totals.root)
        else:
            away.append(abs(got - want[u, w]))
            moved.append(abs(p0[w] - want[u, w]))
    assert max(away) < 0.02 and np.mean(away) < 0.003 and np.mean(moved) > 3 * np.mean(away) and max(moved) > 0.2


def test_a_restaurant_sums_to_one_and_empty_ones_ask_the_root():
    rng = np.random.default_rng(4)
    ui, n, p0 = np.repeat(np.arange(50), 20), rng.integers(1, 9, 1000), np.tile(rng.dirichlet(np.ones(20)), 50)
    customers = np.bincount(ui, n)
    back, own = hpy_lm.restaurants(ui, customers, n, np.tile(np.arange(20), 50), ui, p0, 0.7)
    assert np.bincount(ui, own + back[ui] * p0) == pytest.approx(np.ones(50), abs=1e-12)
    assert (back > 0).all() and (back < 1).all()
