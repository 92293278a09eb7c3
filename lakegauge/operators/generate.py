"""Daily files for the bench of merges: every value is an expression of its keys, so any partitioning makes the same rows."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS, WEEK = 288, 2016


def profile(spark: SparkSession) -> DataFrame:
    """The day's 288 slots with their base value; its numbers are fixed values."""
    slot = F.col("id")
    return spark.range(SLOTS).select(slot.alias("slot_index"), (F.lit(220.0) + 45 * F.sin(slot / 14.0) + 0.85 * (slot % 17)).alias("base_value"))


def devices(spark: SparkSession, n: int) -> DataFrame:
    """n devices over five platforms with two applications each."""
    i = F.col("id")
    return spark.range(n).select(
        i.alias("device_number"), F.format_string("SRV-%06d", i).alias("device_id"), F.format_string("PC-%02d", i % 5).alias("platform_customer_id"),
        F.format_string("AC-%02d-%d", i % 5, F.pmod(F.floor(i / 5), F.lit(2))).alias("application_customer_id"),
        F.element_at(F.array(*map(F.lit, ("DL360", "DL380", "ML350", "XL170"))), (i % 4 + 1).cast("int")).alias("model"),
        F.element_at(F.array(*map(F.lit, ("web", "database", "compute", "storage"))), (F.pmod(F.floor(i / 4), F.lit(4)) + 1).cast("int")).alias("tags"),
    )


def daily_file(spark: SparkSession, n: int, day: str) -> DataFrame:
    """A file of a day: every device's last WEEK readings, five minutes apart, up to the day's end."""
    last = F.lit(day).cast("date").cast("timestamp") + F.expr("INTERVAL 1 DAY")
    times = spark.range(WEEK).select((last - F.make_interval(mins=(F.col("id") + 1) * 5)).alias("metric_time"))
    rows = devices(spark, n).crossJoin(F.broadcast(times)).withColumn("slot_index", ((F.hour("metric_time") * 60 + F.minute("metric_time")) / 5).cast("long"))
    value = F.col("base_value") + F.pmod("device_number", F.lit(23)) * 1.7 + F.pmod(F.dayofyear("metric_time"), F.lit(9)) * 0.6
    return rows.join(F.broadcast(profile(spark)), "slot_index", "left").select(
        "device_id", "metric_time", "application_customer_id", "platform_customer_id", F.lit("power").alias("report_type"), F.lit(day).alias("file_date"),
        F.date_format("metric_time", "yyyy-MM-dd").alias("partition_date"), F.round(value, 4).alias("MetricValue"), "model", "tags", F.lit(True).alias("status"),
        F.concat_ws("-", F.lit(day), "device_id").alias("report_id"),
    )


def daily_files(spark: SparkSession, n: int, first: str, days: int) -> dict[str, DataFrame]:
    """The files of several days in a row, each of which overlaps the one before by six days."""
    start = date.fromisoformat(first)
    return {str(start + timedelta(days=k)): daily_file(spark, n, str(start + timedelta(days=k))) for k in range(days)}
