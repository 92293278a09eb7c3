import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    clean = [(i, " ".join(f"clean{i}word{k} of the" for k in range(60)) + ".", "en", "s", 9) for i in range(20)]
    passage = " ".join(f"Sentence {k} of a passage that two documents have." for k in range(8))
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()]
    planted = [
        (100, clean[0][1], "en", "s", 9),  # a copy
        (101, clean[1][1].replace("clean1word5 ", "other "), "en", "s", 9),  # a near copy
        (102, "12345 --- !!!", "en", "s", 9), (103, None, None, None, None), (104, "", "en", "s", 0),  # no language
        (105, "First it begins here alone. " + passage, "en", "s", 9), (106, "Then it goes on in its way. " + passage + " End of it.", "en", "s", 9),  # a passage twice
        (107, items[0], "en", "s", 9), (108, items[1] + " " + clean[7][1] * 40, "en", "s", 9),  # all and little of a benchmark item
    ]
    return spark.createDataFrame(clean + planted, "doc_id long, text string, lang string, source string, n_chars long")


def stage(spark, docs, name):
    found = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    if name != "tokens":
        assert found.schema.simpleString() == docs.schema.simpleString()
    return {r["doc_id"]: r for r in found.collect()}


def test_stages_catch_what_is_planted_and_keep_the_rest(spark, documents):
    everything = {r["doc_id"] for r in documents.collect()}
    assert everything - set(stage(spark, documents, "language")) == {102, 103, 104}
    assert everything - set(stage(spark, documents, "near_duplicates")) == {100, 101}
    kept = stage(spark, documents, "repeats")
    assert "Sentence 3" in kept[105]["text"] and "Sentence" not in kept[106]["text"] and kept[106]["text"].startswith("Then it goes on")
    before = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert all(kept[i]["text"] == before[i] for i in range(20)) and kept[106]["n_chars"] == len(kept[106]["text"])
    assert everything - set(stage(spark, documents, "benchmarks")) == {107}


def test_run_applies_all_stages(spark):
    docs, ids = spark.read.parquet(f"{SF}/documents.parquet"), None
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, SF)
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert ids is None or now <= ids
        ids = now
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    found = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.select(*found.columns).collect()))
    assert 0 < len(ids) < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_empty_and_wider_documents(spark, documents):
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, documents.limit(0), SF).collect() == []
    made = ("kept", "node", "n_words", "spans", "items", "score", "lang_pred", "cuts", "_cuts", "n_removed", "ids", "contaminated", "_l")
    wide = documents.select("*", *(F.lit(i).alias(c) for i, c in enumerate(made)))
    for name, f in corpus_pipeline.STAGES[:-1]:
        assert set(f(spark, wide, SF).columns) == set(wide.columns), name


def test_language_stage_goes_by_its_model(spark):
    letters = "bcdfghjklmnpqrstvwxz"
    rows = [(i, " ".join(("le la les des une" if i % 2 else "the of and to in").split()[k % 5] for k in range(i, i + 30)), "fr" if i % 2 else "en", "s", 9) for i in range(40)]
    junk = [(100 + i, "".join(letters[(i * 7 + k * k * 3 + k) % 20] + ("\u0416", "\u00df", "\u4e2d")[k % 3] for k in range(40)), None, "s", 9) for i in range(5)]
    docs = spark.createDataFrame([*rows, *junk, (200, "the and of to in the", None, "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = stage(spark, docs, "language")
    assert set(range(40)) | {200} <= set(kept) and kept[200]["lang"] == "en"
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert set(stage(spark, unlabelled, "language")) == {r[0] for r in docs.collect()}
    assert stage(spark, docs.where("doc_id is null"), "language") == {}


def test_a_language_may_be_labelled_as_unknown(spark):
    words = {"und": "the of and to in with for that", "fr": "le la les des une dans pour que"}
    rows = [(i, " ".join(words[lang].split()[(i + k) % 8] for k in range(30)), lang, "s", 9) for i, lang in ((i, "fr" if i % 2 else "und") for i in range(40))]
    docs = spark.createDataFrame([*rows, (100, "12 -- !", "und", "s", 9), (101, None, "und", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = stage(spark, docs, "language")
    assert set(kept) == set(range(40)) and kept[0]["lang"] == "und"
    alone = stage(spark, docs.where("lang = 'und'"), "language")
    assert set(alone) == set(range(0, 40, 2))
