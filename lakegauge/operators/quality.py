"""Checks that return the rows that break a rule, and operating figures."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frequent import top_keys
from .order_stats import quantiles


def duplicates(df: DataFrame, key: Sequence[str], n: int = 20) -> DataFrame:
    """The n keys with most rows, of those with several."""
    return top_keys(df, key, n, least=2).withColumnRenamed("n_rows", "dup_count")


def empties(df: DataFrame, texts: Sequence[str], times: Sequence[str] = ()) -> DataFrame:
    """How many rows have empty or null texts, or times at the epoch."""
    return df.agg(*(F.count_if(F.coalesce(F.col(c), F.lit("")) == "").alias(f"empty_{c}") for c in texts), *(F.count_if(F.col(c) == F.lit("1970-01-01").cast("timestamp")).alias(f"epoch_{c}") for c in times))


def mismatches(a: DataFrame, b: DataFrame, key: Sequence[str], value: str, tolerance: float = 0.0) -> DataFrame:
    """Keys of which a and b differ by more than the tolerance or one side has none."""
    both = a.select(*key, F.col(value).alias("left_value")).join(b.select(*key, F.col(value).alias("right_value")), list(key), "full")
    return both.where(F.col("left_value").isNull() | F.col("right_value").isNull() | (F.abs(F.col("left_value") - F.col("right_value")) > tolerance))


def guard(df: DataFrame, value: str) -> DataFrame:
    """One row: count, mean and whether the table may be served."""
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.avg(value), F.lit(0.0)).alias("mean_value")).withColumn("passed", F.expr("n_rows > 0 and mean_value <> 0"))


def latencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum, mean and exact interpolated percentiles of each column."""
    found = quantiles(df, {c: F.col(c) for c in columns}, (0.5, 0.95, 0.99))
    plain = {"min": F.min, "max": F.max, "mean": F.avg}
    parts = df.agg(*(f(c).alias(f"{c}_{n}") for c in columns for n, f in plain.items()))
    return parts.select("*", *(F.lit(v).cast("double").alias(f"{c}_{n}") for c in columns for n, v in zip(("p50", "p95", "p99"), found[c])))


def throughput(rows: Column, seconds: Column) -> Column:
    """Rows a second of sums; 0 if no time passed."""
    return F.coalesce(F.try_divide(F.sum(rows).cast("double"), F.sum(seconds)), F.lit(0.0))


def breakdown(df: DataFrame, parts: dict[str, Column], total: Column) -> DataFrame:
    """component, mean_time, p95_time and percent of all time."""
    p95 = quantiles(df, parts, (0.95,))
    entry = F.array(*(F.struct(F.lit(n).alias("component"), c.cast("double").alias("t"), F.lit(p95[n][0]).cast("double").alias("p95")) for n, c in parts.items()))
    rows = df.select(total.cast("double").alias("whole"), F.inline(entry))
    return rows.groupBy("component").agg(F.avg("t").alias("mean_time"), F.any_value("p95").alias("p95_time"), (F.try_divide(F.sum("t"), F.sum("whole")) * 100).alias("percent"))


def outliers(df: DataFrame, column: str, share: float = 0.99) -> DataFrame:
    """Rows above the exact percentile, which is a literal of the scan's filter."""
    return df.where(F.col(column) > F.lit(quantiles(df, {column: F.col(column)}, (share,))[column][0]))


def confusion(df: DataFrame, truth: Column, guess: Column) -> DataFrame:
    """One row: counts, accuracy, precision, recall and F1."""
    counts = df.agg(F.count_if(truth & guess).alias("tp"), F.count_if(~truth & guess).alias("fp"), F.count_if(truth & ~guess).alias("fn"), F.count_if(~truth & ~guess).alias("tn"))
    part = lambda a, b: F.coalesce(F.try_divide(F.expr(a).cast("double"), F.expr(b)), F.lit(0.0))
    return counts.withColumns({"accuracy": part("tp + tn", "tp + fp + fn + tn"), "precision": part("tp", "tp + fp"), "recall": part("tp", "tp + fn"), "f1": part("2 * tp", "2 * tp + fp + fn")})


def expected_unique(devices: int, days: int, first: int = 2016, daily: int = 288) -> int:
    """Rows that rolling windows of a week leave after dedup."""
    return devices * (first + (days - 1) * daily) if days > 0 else 0


def file_statistics(df: DataFrame, raw_bytes: Column, file: Column | None = None) -> DataFrame:
    """Files, rows and bytes of a Parquet frame, and what percentage its files save against raw_bytes a row.

    file: the name of the file that a row's part belongs to, for files that are folders of parts as Spark
    writes them; each part is a file by default.
    """
    part = F.col("_metadata.file_path")
    meta = df.select((part if file is None else file).alias("file"), part.alias("part"), F.col("_metadata.file_size").alias("size"), raw_bytes.alias("raw"))
    parts = meta.groupBy("file", "part").agg(F.max("size").alias("size"), F.count("*").alias("n"), F.sum("raw").alias("raw"))
    files = parts.groupBy("file").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.sum("raw").alias("raw"))
    return files.agg(F.count("*").alias("files"), F.sum("n").alias("n_rows"), F.sum("size").alias("bytes"), F.round((1 - F.try_divide(F.sum("size").cast("double"), F.sum("raw"))) * 100, 2).alias("saved_percent"))
