import hashlib
import re

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from lakegauge.llm import fm_index, queries

SF = "/root/testdata/sf0.01"


def words(text):
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=13):
    phrases = {}
    for name, text in items:
        own = words(text)
        for i in range(max(1, len(own) - window + 1) if own else 0):
            phrases.setdefault(tuple(own[i : i + window]), set()).add(str(name))
    sizes = {len(p) for p in phrases}
    for doc_id, text in docs:
        own, hit, names = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if found := phrases.get(tuple(own[i : i + size])):
                    names |= found
                    hit.update(range(i, i + size))
        yield doc_id, len(own), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(own)


def compare(spark, docs, items, **options):
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = fm_index.contamination(a, b, **options).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(brute(docs, items), key=key)


def test_documents(spark):
    read = lambda name, key: [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(key, "text").collect()]
    docs, items = read("documents", "doc_id"), read("benchmark", "item_id")
    compare(spark, docs, items)
    compare(spark, docs[:200], items, block_bytes=2000)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(50))
    items = [(1, long), (2, None), (3, ""), (4, "Two words"), (5, "two WORDS"), (6, "one"), (7, "--- !!"), (None, long), (8, "é ñ 日本")]
    docs = [(1, long.upper() + " x " * 5000), (2, None), (3, ""), (4, "two, words two words"), (5, long + " " + long), (5, long + " " + long), (None, "one"), (9, "ONE" * 3), (10, "É É ñ 日本"), (11, "é-Ñ é ñ 日本 z"), (12, "a b " * 40000 + long)]
    compare(spark, docs, items)
    compare(spark, docs, items[1:3])
    compare(spark, docs, [])
    compare(spark, [], items)
    compare(spark, docs, items, block_bytes=100)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=120), st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=5), min_size=1, max_size=8))
def test_index_finds_every_place(text, phrases):
    index = fm_index.FMIndex(np.array(text), 3)
    size = np.array([len(p) for p in phrases])
    low, high = index.search(np.array([x for p in phrases for x in p]), np.cumsum(size) - size, size)
    for p, a, b in zip(phrases, low, high):
        assert sorted(index.locate(np.arange(a, b))) == [i for i in range(len(text)) if text[i : i + len(p)] == p]


def test_a_block_of_items_takes_little_memory():
    rng = np.random.default_rng(2)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 20000, 400))) for i in range(1000)]
    phrases = fm_index.Phrases(items, 13)
    total = sum(x.nbytes for x in vars(phrases).values() if isinstance(x, np.ndarray))
    assert len(phrases.start) == 1000 * 388 and total < 60 * 400_000


def test_query_equals_its_sql(spark):
    for name in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = duckdb.sql(queries.oracle_sql()["op8_fm_index_decontamination"])
    assert sorted(map(tuple, queries.op8_fm_index_decontamination(spark, SF).select(*want.columns).collect())) == sorted(want.fetchall())
