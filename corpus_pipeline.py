"""A corpus pipeline of the training-data operators: language, near-duplicates, repeats, benchmarks, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written and read again as
the next stage's docs. All but the last return the columns of documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.llm import byte_bpe, fm_index, language_id, minhash_fss, queries, sentence_spans
from lakegauge.llm.workspace import Workspace, prepare, small


#: A document stays if its best language's score is at least so many times an even share of all languages.
STANDS_OUT = 1.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go, and those in which no learned language stands out; a missing lang is filled by the prediction.

    With one learned language there is nothing to tell apart, and without labelled rows no model: then
    documents with letters stay as they are. A label may have any name, that of unknown language too. Null
    and empty texts go; rows that repeat are judged alike.
    """
    prepare(spark)
    model = language_id.fit(docs.where(~language_id.held_out()))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id.predict(docs, model).where(F.col("score") > 0)  # 0 stands for texts without letters alone
    if len(model.languages) > 1:
        found = found.where(F.col("score") >= STANDS_OUT / len(model.languages))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest doc_id; rows that repeat it stay with it."""
    found = minhash_fss.near_duplicates(docs.select("doc_id", "text"), percent=85)
    work = Workspace(spark, "near-duplicates")
    gone = work.write(found.where(~F.col("kept")).select("doc_id").distinct(), "gone")
    kept = docs.join(small(gone), "doc_id", "left_anti").select(*docs.columns)
    return kept


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences that repeat an earlier passage are cut; a document of which only white space is left goes.

    Null and empty texts stay, as nothing is cut from them; of rows that share doc_id and text each keeps what the first keeps.
    """
    found = sentence_spans.remove_repeats(docs)
    left = found.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\s]"))
    cut = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", cut).select(*docs.columns)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go; null and empty texts have no words and stay."""
    items = queries.table(spark, sf_dir, "benchmark", "item_id", "text")
    return fm_index.contamination(docs, items).where(~F.col("contaminated")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document's ids and of the text they decode to.

    Null text is empty and has no ids; texts of any length are taken whole; rows that repeat have a row each;
    an empty table gives an empty one; other columns of docs are not returned, so none can clash.
    """
    pairs = byte_bpe.BytePairs(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return pairs.round_trip(docs.select("doc_id", "text"))


def apart(stage):
    """A stage under which columns beyond those of documents have names that no operator makes."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        more = {c: f"_document_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "lang", "source", "n_chars")}
        found = stage(spark, docs.withColumnsRenamed(more), sf_dir)
        return found.withColumnsRenamed({v: k for k, v in more.items()})

    return run


STAGES = [
    ("language", apart(language)),
    ("near_duplicates", apart(near_duplicates)),
    ("repeats", apart(repeats)),
    ("benchmarks", apart(benchmarks)),
    ("tokens", tokens),
]

#: SQL has no sketches, kernels or merges; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents in sf_dir."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
