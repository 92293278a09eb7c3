"""Writers: batch and partitioned files, hour caches, device silos, job state, batch metrics and train/test splits."""

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def batch(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """Parquet; files merges the output by a rebalancing shuffle, so the work before it keeps its tasks."""
    (df.repartition(files) if files else df).write.mode(mode).option("compression", "zstd").parquet(path)


def partitioned(df: DataFrame, path: str, *by: str, mode: str = "append", max_records: int = 1_000_000) -> None:
    """A folder for each value of by; one shuffle on by keeps the number of files small, and a value with many rows is split."""
    df.hint("rebalance", *map(F.col, by)).write.mode(mode).partitionBy(*by).option("maxRecordsPerFile", max_records).parquet(path)


def hour_cache(df: DataFrame, path: str, time: str = "metric_time") -> None:
    """Rows by date, hour, platform and application; only the hours in df are overwritten."""
    cols = {"date": F.date_format(time, "yyyy-MM-dd"), "hour": F.hour(time), "pcid": F.col("platform_customer_id"), "acid": F.col("application_customer_id")}
    df.withColumns(cols).hint("rebalance", *map(F.col, cols)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "hour", "pcid", "acid").parquet(path)


def silos(df: DataFrame, path: str, device: str = "device_id", per_silo: int = 7000) -> int:
    """A folder for each per_silo devices or so, by a hash of the device; a silo of many rows has several files. Returns the number of silos."""
    n = max(1, -(-df.select(device).distinct().count() // per_silo))
    df.withColumn("silo", F.pmod(F.xxhash64(device), F.lit(n))).hint("rebalance", F.col("silo")).write.mode("overwrite").partitionBy("silo").parquet(path)
    return n


def archive(df: DataFrame, paths: Sequence[str], device: str = "device_id", per_silo: int = 7000, days: int = 7, time: str = "metric_time") -> dict:
    """The newest days in silos at each of several places, each with a marker written last that tells silos, rows and the last time."""
    recent = expire(df, time, days).persist()
    try:
        figures = recent.agg(F.count("*").alias("rows"), F.date_format(F.max(time), "yyyy-MM-dd HH:mm:ss").alias("latest")).collect()[0].asDict()
        for path in paths:
            figures["silos"] = silos(recent, path, device, per_silo)
            write_text(df.sparkSession, f"{path}/_SUCCESS.json", json.dumps(figures))
    finally:
        recent.unpersist()
    return figures


def archived(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """The rows of an archive and its marker; without a marker it is not complete and cannot be read."""
    return spark.read.parquet(path), json.loads(read_text(spark, f"{path}/_SUCCESS.json"))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text; Spark's readers pass over names that begin with an underscore."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


class Progress:
    """Which batches are done, as a JSON file on shared storage."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def load(self) -> dict:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target):
            return {"completed": [], "rows": 0}
        return json.loads(self.spark.read.option("wholetext", "true").text(self.path).collect()[0][0])

    def complete(self, batch_id: str, rows: int) -> dict:
        state = self.load()
        if batch_id not in state["completed"]:
            state = {"completed": [*state["completed"], batch_id], "rows": state["rows"] + rows}
            write_text(self.spark, self.path, json.dumps(state))
        return state

    def reset(self) -> None:
        write_text(self.spark, self.path, json.dumps({"completed": [], "rows": 0}))


def metrics(spark: SparkSession, path: str, rows: list[tuple], schema: str) -> None:
    spark.createDataFrame(rows, schema).write.mode("append").parquet(path)


def expire(df: DataFrame, time: str, days: int, now=None) -> DataFrame:
    """Rows that are not older than so many days before now, or before the newest row."""
    if now is None:
        newest = F.broadcast(df.agg(F.max(time).alias("_now")))
        return df.crossJoin(newest).where(F.col(time) >= F.col("_now") - F.expr(f"INTERVAL {int(days)} DAYS")).drop("_now")
    return df.where(F.col(time) >= now - F.expr(f"INTERVAL {int(days)} DAYS"))


def split_days(df: DataFrame, time: str, share: float = 0.8, label: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The first share of the days without the label, and the other days with it."""
    days = df.select(F.to_date(time).alias("_day")).distinct()
    ranked = days.select("_day", F.row_number().over(Window.orderBy("_day")).alias("_r"), F.count("*").over(Window.partitionBy()).alias("_n"))
    train = ranked.where(F.col("_r") <= F.floor(F.col("_n") * share)).select("_day")
    keyed = df.withColumn("_day", F.to_date(time))
    first = keyed.join(F.broadcast(train), "_day", "left_semi").drop("_day")
    return first.drop(label) if label else first, keyed.join(F.broadcast(train), "_day", "left_anti").drop("_day")


def kafka(stream: DataFrame, servers: str, topic: str, checkpoint: str):
    """A stream's key and value to a topic; needs the connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    return stream.select("key", "value").writeStream.format("kafka").options(**options).start()


def json_folder(stream: DataFrame, path: str, checkpoint: str):
    """A stream's key and value as JSON files, exactly once by the sink's own log."""
    return stream.select("key", "value").writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text for bulk loaders; null is \\N."""
    df.write.mode("overwrite").options(sep="\t", nullValue="\\N", timestampFormat="yyyy-MM-dd HH:mm:ss").csv(path)


def predictions(df: DataFrame, path: str, run: str) -> None:
    """A run's predictions in a folder of its own, which a repeat overwrites."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/run={run}")
