"""The thin queries of this subpackage's operators, and SQL for those that SQL can express."""

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arc_warc, byte_bpe, fm_index, hpy_lm, language_id, license_scan, media_chunks, minhash_fss, resampling, sentence_spans, simple8b, spelling_variants, voronoi_knn
from .pieces import PATTERN  # noqa: F401
from .workspace import Workspace, prepare, table

#: Where the vocabulary files of public tokenizers are.
TOKENIZERS = os.path.dirname(public_tokenizers.path("byte_bpe_50k.json"))


def op1_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_chunks.of_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    _, blocks = simple8b.write_ids(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), end=2)
    return simple8b.read_ids(blocks, digest=True)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.expr("concat(source, '/p', doc_id div 4096, '/d', doc_id div 256, '/', doc_id, '.txt')")
    return license_scan.scan(table(spark, sf_dir, "documents", "doc_id", "source", "text").select("doc_id", place.alias("path"), "text"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return byte_bpe.BytePairs(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).round_trip(docs)


def op5_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_fss.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), percent=85)


def op8_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = fm_index.contamination(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = sentence_spans.remove_repeats(docs)
    return found.select("doc_id", "n_sentences", "n_removed", "removed_bytes", F.expr("n_removed > 0").alias("has_repeat"), "text")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held = language_id.held_out()
    model = language_id.fit(docs.where(~held))
    return language_id.predict(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")


def op9_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "warc")
    return arc_warc.read_archives(spark, arc_warc.write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"), work))


def op10_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held = hpy_lm.held_out()
    model = hpy_lm.train(docs.where(~held))
    return hpy_lm.score(docs.select("doc_id", held.alias("held_out"), "text"), model, ["doc_id", "held_out"])


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_knn.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), every=100, k=10)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text")
    return resampling.resample(docs, target, percent=10, least_words=20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [f for name, f in sorted(globals().items(), key=lambda x: int(x[0][2:].split("_")[0]) if x[0].startswith("op") else 0) if name.startswith("op")]

    def run(f):
        def query(spark, sf_dir):
            prepare(spark)
            return f(spark, sf_dir)

        return query

    return {f.__name__: run(f) for f in found}


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Windows as joined words, met by equality.
CONTAMINATION = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS name, coalesce({_WORDS}, []) AS w FROM benchmark),
phrase AS (SELECT DISTINCT name, least(len(w), 13) AS size, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS words FROM (SELECT name, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
place AS (SELECT r, size, i, array_to_string(w[i : i + size - 1], ' ') AS words FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, (SELECT DISTINCT size FROM phrase) WHERE len(w) >= size)),
found AS (SELECT r, i, p.size, name FROM place l JOIN phrase p ON l.words = p.words AND l.size = p.size),
hits AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS k FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT r, name FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

#: Base32 of 20 bytes: 40 hexadecimal digits, five of which make four characters.
ARCHIVES = """
WITH page AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
first AS (SELECT body, min(page_id) AS first FROM page GROUP BY body),
hex AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS h, first FROM page JOIN first USING (body))
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(h, 1 + 5 * (j // 4), 5) AS BIGINT) >> (15 - 5 * (j % 4))) & 31) AS INTEGER), 1)), '') AS payload_digest,
CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM hex
"""


#: The register's table of CRC-32 for zlib's reflected polynomial, and the code of a text by its bytes.
_CRC_TABLE = "SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"


def _crc(text: str) -> str:
    code = f"hex(encode({text}))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, strlen({text}) + 1), lambda i: CAST('0x' || substr({code}, 2 * i - 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), CAST(4294967295 AS BIGINT))"


#: Near words meet by forms with a character replaced by a sign that words lack, and by forms with one left out; roots by a recursion.
SPELLING = rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
run AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS word FROM documents) GROUP BY ALL),
coded AS (SELECT word, n, length(word) AS size, coalesce({_crc("(doc_id || ':' || word)")}, 1) AS h FROM run, crc),
garbled AS (SELECT CASE WHEN h % 31 = 0 THEN substr(word, 1, CAST(h % size AS BIGINT)) || substr(word, CAST(h % size AS BIGINT) + 2) ELSE word END AS word, n FROM coded),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM garbled WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
place AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
masked AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS mask FROM place),
less AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM place),
pair AS (
  SELECT a.word, b.word AS other, b.n FROM masked a JOIN masked b USING (mask) WHERE a.word <> b.word
  UNION ALL SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.less = w.word
  UNION ALL SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.less = w.word),
near AS (SELECT word, count(*) AS n_near, max(n) AS best_n, arg_min(other, struct_pack(less := -n, o := other)) AS best FROM pair GROUP BY word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form, CASE WHEN best_n >= 10 * n THEN best_n END AS form_n FROM words LEFT JOIN near USING (word)),
chain AS (SELECT word, word AS reached, 0 AS steps FROM formed UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN formed f ON c.reached = f.word WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM formed f JOIN (SELECT word, arg_max(reached, steps) AS root FROM chain GROUP BY word) USING (word)
"""

TOP_K = """
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pair) WHERE rank <= 10
"""

RESAMPLING = f"""
WITH crc AS ({_CRC_TABLE}),
doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
target AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
used AS (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM doc) GROUP BY ALL),
word AS (SELECT word, {_crc("word")} % 10000 AS bucket FROM (SELECT word FROM used UNION SELECT word FROM target), crc),
corpus AS (SELECT bucket, sum(n) AS s FROM used JOIN word USING (word) GROUP BY bucket),
wanted AS (SELECT bucket, count(*) AS t FROM target JOIN word USING (word) GROUP BY bucket),
total AS (SELECT (SELECT coalesce(sum(s), 0) FROM corpus) AS s_all, (SELECT count(*) FROM target) AS t_all),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (s_all + 10000) / (CAST(s + 1 AS DOUBLE) * (t_all + 10000)))) AS BIGINT) AS g FROM corpus LEFT JOIN wanted USING (bucket), total),
weighed AS (SELECT r, sum(n * g) AS weight FROM used JOIN word USING (word) JOIN gain USING (bucket) GROUP BY r),
scored AS (SELECT r, doc_id, len(w) AS size, CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM doc LEFT JOIN weighed USING (r)),
noisy AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, r) AS rank FROM noisy WHERE size >= 20 AND doc_id IS NOT NULL)
SELECT doc_id, CAST(size AS BIGINT) AS n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM ranked) * 10 // 100 THEN rank END AS rank FROM noisy LEFT JOIN ranked USING (r)
"""


def oracle_sql() -> dict[str, str]:
    files = "SELECT doc_id, source || '/p' || (doc_id // 4096) || '/d' || (doc_id // 256) || '/' || doc_id || '.txt' AS path, text FROM documents"
    return {"op3_license_scan": license_scan.oracle(files, "doc_id"), "op8_fm_index_decontamination": CONTAMINATION, "op9_arc_to_warc": ARCHIVES} | {"op11_spelling_variants": SPELLING, "op12_voronoi_top_k": TOP_K, "op13_importance_resampling": RESAMPLING}
