"""Operating queries: exports, counters, sessions, statistics, windows of streams, and a whole inference cycle."""

from pyspark.sql import functions as F

from ..operators import health, quality, telemetry
from ..session import scratch
from ..sources import sinks, tables
from ..streaming import jobs
from .pipelines import _CLASS, _RECORD, _as_files, _classified, landed
from .registry import S, query, read, stamp


@query("""SELECT CAST(user_id AS VARCHAR) AS device_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS metric_time, round(avg(sqrt(value)), 2) AS avg_metric_value, round(max(sqrt(value)), 2) AS max_metric_value, round(min(sqrt(value)), 2) AS min_metric_value,
arg_min(event_type, ts) AS report_type, 'power_metrics' AS metric_id, NULL::VARCHAR AS cpu_inventory, NULL::DOUBLE AS amb_temp, epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP)) + 60 AS "timeRangeEnd" FROM events GROUP BY user_id, CAST(ts AS DATE)""")
def stream_refined_projection(spark, sf):
    path, schema, each = _as_files(spark, sf)
    out = scratch(spark, "refined")
    flat = jobs.files(spark, path, schema, per_trigger=2 * each).select(F.col("user_id").cast("string").alias("device_id"), F.col("ts").alias("event_time"), F.sqrt("value").alias("value"), F.col("event_type").alias("report_type"))
    jobs.complete(telemetry.refine_daily(flat, F.lit("2026-01-01").cast("timestamp")), out, scratch(spark, "checkpoint")).awaitTermination()
    rows = spark.read.parquet(out)
    assert len(rows.columns) == 36
    return rows.select("device_id", "metric_time", "avg_metric_value", "max_metric_value", "min_metric_value", "report_type", "metric_id", "cpu_inventory", "amb_temp", "timeRangeEnd")


@query("SELECT event_id, user_id AS device, n_name AS platform_customer_id, c_mktsegment AS application_customer_id, coalesce(CASE WHEN event_id % 4 <> 0 THEN value END, 20.0::DOUBLE) AS amb_temp FROM events LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey WHERE event_type <> 'click'")
def hot_path_append(spark, sf):
    registry = read(spark, sf, "customer").join(F.broadcast(read(spark, sf, "nation")), F.col("n_nationkey") == F.col("c_nationkey"), "left").select(F.col("c_custkey").alias("device"), F.col("n_name").alias("platform_customer_id"), F.col("c_mktsegment").alias("application_customer_id"))
    polled = read(spark, sf, "events").selectExpr("event_id", "user_id AS device", "CASE WHEN event_type = 'click' THEN 'failed' ELSE 'success' END AS status", "CASE WHEN event_id % 4 <> 0 THEN value END AS amb_temp")
    return telemetry.hot_rows(polled, registry, "device", {"amb_temp": 20.0})


@query("""SELECT CAST(user_id AS VARCHAR) AS key, user_id AS device, any_value(coalesce(c_mktsegment, 'none')) AS segment, count(*) AS n, max(value) AS top FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) LEFT JOIN customer ON c_custkey = user_id WHERE rn <= 12 GROUP BY user_id""")
def hydrated_messages(spark, sf):
    readings = read(spark, sf, "events").select(F.col("user_id").alias("device"), "ts", "event_id", "value")
    registry = read(spark, sf, "customer").select(F.col("c_custkey").alias("device"), F.col("c_mktsegment").alias("segment"))
    made = telemetry.messages(readings, registry, telemetry.points(1), "device", [F.desc("ts"), F.desc("event_id")], "ts", "value", {"segment": "none"})
    back = F.from_json("value", "device bigint, segment string, Maximum double, PowerDetail array<struct<Average:double>>")
    return made.select("key", back.alias("v")).select("key", "v.device", "v.segment", F.size("v.PowerDetail").cast("bigint").alias("n"), F.col("v.Maximum").alias("top"))


@query(f"SELECT {_CLASS} AS error_type, CASE WHEN event_id % 8 = 1 THEN 'retry' ELSE 'failure' END AS route, count(*) AS n FROM events WHERE event_id % 8 <> 0 GROUP BY ALL")
def dlq_counters(spark, sf):
    bad = _classified(spark, sf).where("error_type <> 'VALID'").withColumn("attempts", F.lit(0))
    return telemetry.route(bad).groupBy("error_type", "route").agg(F.count("*").alias("n"))


@query("SELECT event_id, 'failure' AS route FROM events WHERE event_id % 8 <> 0")
def dlq_retry_cap(spark, sf):
    return telemetry.route(_classified(spark, sf).where("error_type <> 'VALID'").withColumn("attempts", F.lit(3))).select("event_id", "route")


@query("SELECT user_id % 50 AS device, min(event_type) AS event_type FROM events WHERE user_id % 50 NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey < 30) GROUP BY 1")
def register_new_devices(spark, sf):
    requests = read(spark, sf, "events").selectExpr("user_id % 50 AS device", "event_type").groupBy("device").agg(F.min("event_type").alias("event_type"))
    return telemetry.unregistered(requests, read(spark, sf, "supplier").where("s_suppkey < 30").select(F.col("s_suppkey").alias("device")), "device")


@query("SELECT conv_id, count(*) AS n_messages, max(turn) AS last_turn, arg_min(text, turn) AS opening FROM conversations GROUP BY conv_id")
def session_list(spark, sf):
    return read(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").alias("n_messages"), F.max("turn").alias("last_turn"), F.min_by("text", "turn").alias("opening"))


@query("SELECT turn, role, text FROM conversations WHERE conv_id = (SELECT min(conv_id) FROM conversations) ORDER BY turn")
def session_messages(spark, sf):
    talks = read(spark, sf, "conversations")
    first = talks.agg(F.min("conv_id").alias("conv_id"))
    return talks.join(F.broadcast(first), "conv_id", "left_semi").orderBy("turn").select("turn", "role", "text")


@query(f"SELECT strftime(max(ts), {S}) AS latest, round(avg(value), 4) AS mean_value FROM events")
def archive_check(spark, sf):
    return read(spark, sf, "events").agg(stamp(F.max("ts")).alias("latest"), F.round(F.avg("value"), 4).alias("mean_value"))


@query("SELECT user_id, round(avg(value), 6) AS mean_value FROM events GROUP BY user_id ORDER BY user_id LIMIT 10")
def sample_averages(spark, sf):
    return read(spark, sf, "events").groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("mean_value")).orderBy("user_id").limit(10)


@query(f"SELECT user_id, strftime(max(ts), {S}) AS last_time, round((epoch(TIMESTAMP '2024-06-01') - epoch(date_trunc('second', max(ts)))) / 3600, 4) AS hours_behind FROM events GROUP BY user_id ORDER BY max(ts), user_id LIMIT 20")
def oldest_watermarks(spark, sf):
    marks = read(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("t")).orderBy("t", "user_id").limit(20)
    behind = (F.unix_timestamp(F.lit("2024-06-01").cast("timestamp")) - F.unix_timestamp("t")) / 3600
    return marks.select("user_id", stamp("t").alias("last_time"), F.round(behind, 4).alias("hours_behind"))


@query("SELECT count(*) AS n_rows, 3 AS files, true AS sizes_hold FROM lineitem")
def file_statistics(spark, sf):
    """Three files of all rows, each a folder of as many parts as its rows need, so that no task gathers a third of the table."""
    path = scratch(spark, "files")
    landed(read(spark, sf, "lineitem"), path, 3, folder="file")
    found = quality.file_statistics(spark.read.parquet(path), F.lit(100), F.regexp_extract("_metadata.file_path", "^(.*/file=[0-9]+)/", 1))
    return found.select("n_rows", F.col("files").cast("int").alias("files"), F.expr("bytes > 0 AND abs(saved_percent - (1 - bytes / (100D * n_rows)) * 100) < 0.01").alias("sizes_hold"))


@query(f"""SELECT strftime(w, {S}) AS window_start, event_type, count(*) AS n FROM (SELECT event_type, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS w FROM events) GROUP BY ALL""")
def sliding_windows(spark, sf):
    path, schema, each = _as_files(spark, sf)
    out = scratch(spark, "windows")
    windows = jobs.by_window(jobs.files(spark, path, schema, per_trigger=2 * each), "ts", "2 hours", ["event_type"], [F.count("*").alias("n")], late="400 days", slide="1 hour")
    jobs.complete(windows, out, scratch(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).select(stamp("window_start").alias("window_start"), "event_type", "n")


@query(f"""SELECT user_id, strftime(min(ts), {S}) AS session_start, count(*) AS n FROM (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s
FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS b FROM events)) GROUP BY user_id, s""")
def session_windows(spark, sf):
    path, schema, each = _as_files(spark, sf)
    out = scratch(spark, "sessions")
    found = jobs.sessions(jobs.files(spark, path, schema, per_trigger=2 * each), "ts", "6 hours", ["user_id"], [F.count("*").alias("n")], late="400 days")
    jobs.complete(found, out, scratch(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).select("user_id", stamp("session_start").alias("session_start"), "n")


@query("SELECT CAST(count(*) AS BIGINT) AS row_count FROM events")
def stream_batch_metrics(spark, sf):
    """Every micro-batch leaves a row of metrics in a folder of its number."""
    path, schema, each = _as_files(spark, sf)
    out = scratch(spark, "metrics")

    def step(df, batch_id):
        df.agg(F.lit(batch_id).alias("batch_id"), F.count("*").alias("row_count")).write.mode("overwrite").parquet(f"{out}/n={batch_id}")

    jobs.files(spark, path, schema, per_trigger=each).writeStream.foreachBatch(step).option("checkpointLocation", scratch(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).agg(F.sum("row_count").alias("row_count"))


@query(f"SELECT {_CLASS} AS error_type, count(*) AS n FROM events GROUP BY 1")
def stream_classified(spark, sf):
    path, out = scratch(spark, "raw"), scratch(spark, "counts")
    each = landed(_classified(spark, sf).select("value"), path, 3)
    counts = jobs.parse(jobs.files(spark, path, "value string", per_trigger=each), _RECORD).groupBy("error_type").agg(F.count("*").alias("n"))
    jobs.complete(counts, out, scratch(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out)


@query("SELECT p_partkey, p_type AS model, CAST(p_size AS INTEGER) AS cores, NULL::INTEGER AS memory_gb FROM part")
def inventory_text(spark, sf):
    text = F.concat(F.lit("Model: "), "p_type", F.lit("\nCores : "), "p_size", F.lit(" cores\nOther: 1"))
    return read(spark, sf, "part").select("p_partkey", tables.inventory(text).alias("i")).select("p_partkey", "i.*")


@query()
def inference_cycle(spark, sf):
    """Features, forest, threshold, prediction, health and status of readings, scores stored in between."""
    value, day = F.col("value"), F.date_trunc("day", "ts")
    readings = read(spark, sf, "events").select(
        "event_id", F.col("user_id").cast("string").alias("device_id"), F.col("event_type").alias("tags"), F.col("ts").alias("metric_time"), F.date_sub(day.cast("date"), 30).cast("timestamp").alias("last_boot_time"), F.lit(2).alias("socket_count"),
        value.alias("avg_metric_value"), (value * 1.2).alias("max_metric_value"), (value * 0.8).alias("min_metric_value"), (value / 2 + 20).alias("cpu_temperature"), F.lit(22.0).alias("amb_temp"), (value * 30).alias("fan_speed_rpm"),
        value.alias("cpu_utilization"), (100 - value).alias("memory_utilization"), F.lit(40.0).alias("disk_utilization"),
    )
    rows, numbers = health.features(readings), ["avg_metric_value", "uptime_hours", "fan_temp_ratio", "cpu_memory_ratio"]
    ready = health.Preprocessor.fit(rows, numbers, ["tags"]).transform(rows)
    scored = health.IsolationForest(trees=60).fit(ready, [f"x_{c}" for c in (*numbers, "tags")]).score(ready).select("event_id", "device_id", "hour_of_day", "avg_metric_value", "anomaly_score")
    path = scratch(spark, "scores")
    sinks.batch(scored, path)
    scored = spark.read.parquet(path)
    limits = health.threshold(scored)
    done = health.health(scored, low=limits["min_score"], high=limits["max_score"])
    return done.withColumn("prediction", health.prediction(F.col("anomaly_score"), F.lit(limits["threshold"]))).drop("ahc", "dhc", "tcc")


def _exported(spark, sf, platform: str):
    registry = read(spark, sf, "customer").join(F.broadcast(read(spark, sf, "nation")), F.col("n_nationkey") == F.col("c_nationkey"))
    registry = registry.select(F.col("c_custkey").alias("user_id"), F.when(F.col("c_custkey") % 9 == 4, "P0").otherwise(F.concat(F.lit("P"), F.col("c_custkey") % 4 + 1)).alias("platform"), F.expr("CASE WHEN c_custkey % 5 <> 0 THEN n_name END").alias("place"))
    readings = read(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return telemetry.hierarchy_export(readings, registry, "user_id", "ts", "2024-01-03", "2024-01-20", {"place": "unknown"}, platform=platform)


@query("""SELECT event_id, user_id, 'P2' AS platform, CASE WHEN c_custkey % 5 <> 0 THEN n_name ELSE 'unknown' END AS place, value FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-20' AND c_custkey % 9 <> 4 AND c_custkey % 4 = 1""")
def hierarchy_export(spark, sf):
    """A platform's readings of a range, with the registry's attributes."""
    return _exported(spark, sf, "P2").drop("ts")


@query("SELECT count(*) AS n FROM customer WHERE false")
def empty_hierarchy_export(spark, sf):
    """A platform without devices has no readings, and no error."""
    return _exported(spark, sf, "P9").agg(F.count("*").alias("n"))
