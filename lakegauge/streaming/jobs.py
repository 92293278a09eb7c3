"""Structured Streaming jobs: parse, split, window, and idempotent sinks."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import records
from ..operators.telemetry import one_per_key
from ..sources.store import Store


def files(spark: SparkSession, path: str, schema: str, kind: str = "parquet", per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """A stream of files with a declared schema."""
    reader = spark.readStream.schema(schema).format(kind)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def enveloped(stream: DataFrame) -> DataFrame:
    """value as text, with topic, partition, offset and the time it was stored, as a broker's source has them."""
    return stream.select(F.col("value").cast("string").alias("value"), "topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"), F.col("timestamp").alias("stored_at"))


def parse(stream: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """raw, record, error_type and parsed of JSON records, by the rule that batches have."""
    return records.classified(stream, schema, value)


def by_window(stream: DataFrame, time: str, size: str, keys: Sequence[str], aggregates: Sequence[Column], late: str, slide: str | None = None) -> DataFrame:
    """Aggregates by key and window of time with a watermark, so that state ends and late rows are dropped."""
    grouped = stream.withWatermark(time, late).groupBy(F.window(time, size, slide) if slide else F.window(time, size), *keys)
    return grouped.agg(*aggregates).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *(c for c in _names(aggregates)))


def sessions(stream: DataFrame, time: str, gap: str, keys: Sequence[str], aggregates: Sequence[Column], late: str) -> DataFrame:
    grouped = stream.withWatermark(time, late).groupBy(F.session_window(time, gap), *keys)
    return grouped.agg(*aggregates).select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *keys, *_names(aggregates))


def _names(aggregates: Sequence[Column]) -> list[str]:
    return [a._jc.toString().rpartition(" AS ")[2].strip("`") if hasattr(a, "_jc") else a.name for a in aggregates]


def into_store(stream: DataFrame, store: Store, order: Sequence[str], checkpoint: str, compact_every: int = 5, cluster: Sequence[str] = (), newer_only: str | None = None):
    """Merge each micro-batch into a table; a failure raises, so the batch is run again. Keyed merges make a repeat harmless."""

    def step(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            if not df.isEmpty():
                store.merge(df, order, newer_only=newer_only)
                if compact_every and (batch_id + 1) % compact_every == 0:
                    store.optimize(*cluster)
        finally:
            df.unpersist()

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()


def complete(stream: DataFrame, path: str, checkpoint: str):
    """The whole result of an aggregate at path after each micro-batch, which a repeat overwrites."""
    step = lambda df, _: df.write.mode("overwrite").parquet(path)
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).outputMode("complete").trigger(availableNow=True).start()


def split_sinks(parsed: DataFrame, good: str, bad: str, checkpoint: str):
    """Write valid and other records of each micro-batch in one pass, in a folder of the batch's number that a repeat overwrites."""

    def step(df: DataFrame, batch_id: int) -> None:
        df = df.select("raw", "error_type", "parsed").persist()  # what is written, and not the text twice with its variant
        try:
            df.where("error_type = 'VALID'").select("parsed.*").write.mode("overwrite").parquet(f"{good}/batch={batch_id}")
            df.where("error_type <> 'VALID'").select("raw", "error_type").write.mode("overwrite").parquet(f"{bad}/batch={batch_id}")
        finally:
            df.unpersist()

    return parsed.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_updates(updates: DataFrame, key: Sequence[str], batch: str = "batch") -> DataFrame:
    """Of several partial rows of a key the one of the latest batch."""
    return one_per_key(updates, key, [batch])
