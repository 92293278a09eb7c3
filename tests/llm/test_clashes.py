from lakegauge.llm import byte_bpe, fm_index, language_id, license_scan, media_chunks, minhash_fss, queries, sentence_spans, simple8b
from pyspark.sql import functions as F


def test_columns_named_as_the_made_ones_are_replaced(spark):
    docs = spark.createDataFrame([(1, "Some text here. " * 9), (2, None)], "doc_id long, text string")
    wide = lambda *names: docs.select("*", *(F.lit("x").alias(n) for n in names))
    pairs = byte_bpe.BytePairs(spark, f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken", queries.PATTERN)
    items = spark.createDataFrame([(1, "some text here")], "item_id long, text string")
    labelled = docs.withColumn("lang", F.lit("en"))
    made = {
        "ids": lambda: pairs.encode(wide("ids", "char_start")),
        "n_tokens": lambda: pairs.round_trip(wide("n_tokens", "ids_sha256")),
        "decoded": lambda: pairs.decode(pairs.encode(wide("decoded"))),
        "contaminated": lambda: fm_index.contamination(wide("spans", "Items", "n_words", "contaminated", "n_hit"), items),
        "n_removed": lambda: sentence_spans.remove_repeats(wide("n_removed", "_cuts", "_doc", "doc", "digest")),
        "score": lambda: language_id.predict(wide("lang_pred", "score"), language_id.fit(labelled)),
        "origin": lambda: license_scan.scan(wide("origin", "_row", "licence", "term").withColumn("path", F.lit("a/b"))),
        "kept": lambda: minhash_fss.near_duplicates(wide("kept", "node", "bands", "high")),
        "media_bytes": lambda: media_chunks.of_documents(wide("media_bytes", "sha", "own", "kind")),
        "start": lambda: simple8b.read_ids(simple8b.write_ids(spark, wide("start", "shard", "words"), f"{queries.TOKENIZERS}/byte_bpe_50k.json", 2)[1], digest=True),
    }
    for name, run in made.items():
        found = run()
        rows = found.collect()
        assert len(rows) == 2 and [c.lower() for c in found.columns].count(name) == 1, name
        assert all(r[name] != "x" for r in rows), name
