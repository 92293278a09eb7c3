"""Rollups, nested reports, classification and repair, stores, streams, generators and health over the test tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalar
from ..operators import frequent, generate, health, quality, records, sketches, telemetry
from ..session import scratch
from ..sources import sinks
from ..sources.store import Store
from ..streaming import jobs
from .registry import S, query, read, stamp


# rollups

_HOURLY = f"SELECT user_id, strftime(date_trunc('hour', ts), {S}) AS bucket, round(avg(value), 6) AS avg_value, max(value) AS max_value, min(value) AS min_value, count(*) AS record_count FROM events GROUP BY user_id, date_trunc('hour', ts)"


def _states(spark, sf, bucket="hour") -> DataFrame:
    return telemetry.rollup_states(read(spark, sf, "events"), ["user_id"], F.date_trunc(bucket, "ts"), "value")


def _finished(states: DataFrame) -> DataFrame:
    return telemetry.finalize(states).withColumns({"avg_value": F.round("avg_value", 6), "bucket": stamp("bucket")})


@query(_HOURLY)
def hourly_rollup(spark, sf):
    return _finished(_states(spark, sf))


@query(_HOURLY.replace("'hour'", "'day'"))
def daily_rollup(spark, sf):
    return _finished(_states(spark, sf, "day"))


@query(_HOURLY.replace("'hour'", "'day'"))
def rollup_merge_states(spark, sf):
    return _finished(telemetry.merge_states(_states(spark, sf), ["user_id"], F.date_trunc("day", "bucket")))


@query(_HOURLY)
def rollup_refresh_touched(spark, sf):
    events = read(spark, sf, "events")
    stale = telemetry.rollup_states(events.where("event_id % 4 <> 0"), ["user_id"], F.date_trunc("hour", "ts"), "value")
    touched = events.where("event_id % 4 = 0").select("user_id", F.date_trunc("hour", "ts").alias("bucket"))
    return _finished(telemetry.refresh(stale, touched, events, ["user_id"], F.date_trunc("hour", "ts"), "value"))


# nested reports


def golden(spark, sf) -> DataFrame:
    """Orders with their lines as nested reports of a device."""
    line = F.struct(
        F.lit(21.5).alias("AmbTemp"), F.sqrt("l_extendedprice").alias("Average"), F.lit(2400).cast("bigint").alias("CpuAvgFreq"), F.lit(90).cast("bigint").alias("CpuMax"), F.lit(0).cast("bigint").alias("CpuPwrSavLim"),
        F.lit(50).cast("bigint").alias("CpuUtil"), F.col("l_quantity").cast("bigint").alias("CpuWatts"), F.lit(5).cast("bigint").alias("GpuWatts"), F.col("l_tax").alias("Minimum"), (F.col("l_extendedprice") + 1).alias("Peak"),
        scalar.iso(F.col("l_shipdate")).alias("Time"), F.lit(True).alias("is_fresh"),
    )
    lines = read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("PowerDetail"))
    orders = read(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    text = {c: F.lit(c) for c in telemetry.DIMENSIONS} | {"device_id": F.col("o_custkey").cast("string"), "report_id": F.col("o_orderkey").cast("string"), "status": F.lit(True), "report_type": F.col("o_orderpriority"), "error_reason": F.lit(None).cast("string")}
    data = F.struct(F.col("o_orderkey").cast("string").alias("Id"), F.lit(0.0).alias("Average"), F.lit(0.0).alias("Maximum"), F.lit(0.0).alias("Minimum"), F.lit("power").alias("Name"), "PowerDetail")
    inventory = F.from_json(F.concat(F.lit('{"cpu_count":2,"socket_count":'), F.col("o_custkey") % 4, F.lit(',"cpu_inventory":[{"model":"x","speed":2400,"total_cores":8}],"memory_inventory":[]}')), "cpu_count bigint, socket_count bigint, cpu_inventory array<struct<model:string,speed:bigint,total_cores:bigint>>, memory_inventory array<struct<memory_size:bigint,operating_freq:bigint,memory_device_type:string>>")
    return orders.select(*(v.alias(c) for c, v in text.items()), data.alias("data"), inventory.alias("inventory_data"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS report_id, CAST(any_value(o_custkey) AS VARCHAR) AS device_id, any_value(o_orderpriority) AS report_type, round(avg(sqrt(l_extendedprice)), 2) AS avg_metric_value, round(max(sqrt(l_extendedprice)), 2) AS max_metric_value, round(min(sqrt(l_extendedprice)), 2) AS min_metric_value,
CAST(max(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS max_cpu_watts, round(max(l_extendedprice + 1), 2) AS max_peak_power, CAST(any_value(o_custkey) % 4 AS INTEGER) AS socket_count,
'[{"model":"x","speed":2400,"total_cores":8}]' AS cpu_inventory, 'power_metric' AS metric_id, strftime(max(l_shipdate), '%Y-%m-%dT%H:%M:%SZ') AS metric_time, epoch(date_trunc('second', max(l_shipdate))) AS datetime, epoch(date_trunc('second', max(l_shipdate))) + 60 AS "timeRangeEnd", strftime(max(l_shipdate), '%Y-%m-%d') AS location_date
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def batch_refined_rows(spark, sf):
    rows = telemetry.refine(golden(spark, sf), F.lit("2026-01-01").cast("timestamp"))
    return rows.select("report_id", "device_id", "report_type", "avg_metric_value", "max_metric_value", "min_metric_value", "max_cpu_watts", "max_peak_power", "socket_count", "cpu_inventory", "metric_id", "metric_time", "datetime", "timeRangeEnd", "location_date")


@query("SELECT l_orderkey, round(avg(sqrt(l_extendedprice)), 2) AS \"Average\", min(l_tax) AS \"Minimum\", max(l_discount) AS \"Maximum\", count(*) AS n_readings FROM lineitem GROUP BY 1")
def power_detail_aggregate(spark, sf):
    lines = read(spark, sf, "lineitem").withColumn("watts", F.sqrt("l_extendedprice"))
    found = telemetry.power_detail(lines, ["l_orderkey"], "l_shipdate", "watts", "l_tax", "l_discount", "l_linenumber")
    return found.select("l_orderkey", "Average", "Minimum", "Maximum", F.size("PowerDetail").cast("bigint").alias("n_readings"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice AS \"Average\" FROM lineitem")
def nested_collect_explode(spark, sf):
    found = telemetry.power_detail(read(spark, sf, "lineitem"), ["l_orderkey"], "l_shipdate", "l_extendedprice", "l_tax", "l_discount", "l_linenumber")
    return telemetry.flatten(found, "PowerDetail", ["l_orderkey"]).select("l_orderkey", "l_linenumber", "Average")


@query("SELECT user_id, round(avg(value), 6) AS mean_value, max(value) AS max_value, min(value) AS min_value, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 24 GROUP BY user_id")
def latest_n_export(spark, sf):
    latest = telemetry.first_rows(read(spark, sf, "events"), 2 * 12, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return latest.groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("mean_value"), F.max("value").alias("max_value"), F.min("value").alias("min_value"), F.count("*").alias("n"))


@query(f"SELECT event_id, user_id, strftime(ts, {S}) AS at FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-05' AND user_id % 5 = 2 AND event_type = 'click'")
def hybrid_range_export(spark, sf):
    """Hours that the cache holds come from it, others from the readings."""
    from ..sources import tables

    path, rows = scratch(spark, "hours"), read(spark, sf, "events").select("event_id", "user_id", F.col("ts").alias("metric_time"), F.format_string("P%d", F.col("user_id") % 5).alias("platform_customer_id"), F.col("event_type").alias("application_customer_id"))
    sinks.hour_cache(tables.time_range(rows, "metric_time", "2024-01-03", "2024-01-04"), path)
    cached = tables.hour_cache(spark, path, "2024-01-03", "2024-01-05", "P2", "click").select("event_id", "user_id", "metric_time")
    wanted = spark.sql("SELECT explode(sequence(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-04 23:00:00', INTERVAL 1 HOUR)) AS h")
    have = spark.read.parquet(path).select(F.to_timestamp(F.concat_ws(" ", F.col("date").cast("string"), F.format_string("%02d:00:00", "hour"))).alias("h")).distinct()
    missing = F.broadcast(wanted.join(have, "h", "left_anti"))  # an hour of the range each
    recent = tables.time_range(rows, "metric_time", "2024-01-03", "2024-01-05").where("platform_customer_id = 'P2' AND application_customer_id = 'click'").withColumn("h", F.date_trunc("hour", "metric_time")).join(missing, "h", "left_semi")
    return cached.unionByName(recent.select("event_id", "user_id", "metric_time")).select("event_id", "user_id", stamp("metric_time").alias("at"))


@query("SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, count(DISTINCT user_id) AS devices, true AS same, true AS near, true AS rank_near FROM events GROUP BY ALL")
def sketch_days_from_hours(spark, sf):
    """Days' distinct devices and median from hours' stored sketches: the distinct estimate is that of the rows themselves, and both are within their errors."""
    by, events, path = ["event_type"], read(spark, sf, "events"), scratch(spark, "sketches")
    hour, day = F.date_trunc("hour", "ts"), lambda c: F.date_format(c, "yyyy-MM-dd")
    sinks.batch(sketches.registers(events, by, hour, "user_id"), f"{path}/distinct")
    sinks.batch(sketches.ranks(events, by, hour, "value"), f"{path}/ranks")
    of_hours = sketches.distinct_estimates(sketches.merged_registers(spark.read.parquet(f"{path}/distinct"), by, day("bucket")), by)
    of_rows = sketches.distinct_estimates(sketches.registers(events, by, day("ts"), "user_id"), by).withColumnRenamed("distinct", "from_rows")
    medians = sketches.merged_ranks(spark.read.parquet(f"{path}/ranks"), by, day("bucket")).select(*by, "bucket", "n", sketches.rank_quantile(0.5).alias("median"))
    both = of_hours.join(of_rows, [*by, "bucket"]).join(medians, [*by, "bucket"])
    exact = events.withColumn("bucket", day("ts")).join(medians.drop("n"), [*by, "bucket"]).groupBy(*by, "bucket").agg(F.countDistinct("user_id").alias("devices"), F.avg((F.col("value") <= F.col("median")).cast("double")).alias("rank"))
    error = 5 * 1.04 / 2 ** (sketches.REGISTER_BITS / 2)
    return both.join(exact, [*by, "bucket"]).select(
        "event_type", F.col("bucket").alias("day"), "n", "devices", (F.col("distinct") == F.col("from_rows")).alias("same"), (F.abs(F.col("distinct") - F.col("devices")) <= 1 + error * F.col("devices")).alias("near"),
        (F.abs(F.col("rank") - 0.5) <= 5 / sketches.RANK_K + 1 / F.col("n")).alias("rank_near"),
    )


@query("""WITH r AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, value - 20 AS v FROM events), k AS (SELECT *, row_number() OVER (PARTITION BY event_type, day ORDER BY v) - 1 AS rank, count(*) OVER (PARTITION BY event_type, day) AS n FROM r)
SELECT event_type, day, CAST(n AS BIGINT) AS n, CAST(sign(v) AS INTEGER) AS sign, CAST(CASE WHEN v = 0 THEN 0 ELSE ceil(ln(abs(v)) / ln(1.02::DOUBLE)) END AS INTEGER) AS power FROM k WHERE rank = floor(0.9::DOUBLE * (n - 1))""")
def cell_quantile_days(spark, sf):
    """Days' ninetieth percentile from hours' stored cells: the very cell that holds it."""
    path, events = scratch(spark, "cells"), read(spark, sf, "events").withColumn("v", F.col("value") - 20)
    sinks.batch(sketches.cells(events, ["event_type"], F.date_trunc("hour", "ts"), "v"), path)
    days = sketches.merged_cells(spark.read.parquet(path), ["event_type"], F.date_format("bucket", "yyyy-MM-dd"))
    return sketches.cell_quantiles(days, ["event_type"], 0.9).select("event_type", F.col("bucket").alias("day"), "n", "sign", "power")


@query("SELECT l_partkey, count(*) AS n_rows FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def frequent_parts(spark, sf):
    """No part stands out here, so the summaries prove nothing and all are counted."""
    return frequent.top_keys(read(spark, sf, "lineitem"), ["l_partkey"], 20)


@query("SELECT word, count(*) AS n_rows FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def frequent_words(spark, sf):
    """A few words stand out, and only likely ones are counted."""
    return frequent.top_keys(read(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("word")), ["word"], 20)


# classification and repair

_RAW = """CASE CAST(event_id % 8 AS INTEGER)
WHEN 0 THEN '{"device_id":"d' || user_id || '","created_at":"2026-01-02T03:04:05Z","data":{"PowerDetail":[{"Average":1.5}]},"inventory_data":{"socket_count":4}}'
WHEN 1 THEN '{"device_id":"d","created_at":"02/01/2026 03:04:05","data":{"PowerDetail":[]},"inventory_data":{"socket_count":"4"}}'
WHEN 2 THEN '{"device_id":null,"data":{"PowerDetail":[]},"inventory_data":{"socket_count":4}}'
WHEN 3 THEN '{"device_id":"d","data":{"PowerDetail":[{"Average":2}]}}'
WHEN 4 THEN '{oops'
WHEN 5 THEN ''
WHEN 6 THEN '{"device_id":"d","inventory_data":{"socket_count":2}}'
ELSE '{"device_id":"d","created_at":"never","data":{"PowerDetail":[]},"inventory_data":{"socket_count":"x"}}' END"""
_RECORD = "device_id string, created_at string, data struct<PowerDetail:array<struct<Average:double>>>, inventory_data struct<socket_count:bigint>"
_CLASS = "CASE CAST(event_id % 8 AS INTEGER) WHEN 0 THEN 'VALID' WHEN 1 THEN 'INVALID_SOCKET_COUNT' WHEN 2 THEN 'MISSING_DEVICE_ID' WHEN 3 THEN 'INVALID_SOCKET_COUNT' WHEN 4 THEN 'MISSING_DEVICE_ID' WHEN 5 THEN 'INVALID_SCHEMA' WHEN 6 THEN 'MISSING_POWERDETAIL' ELSE 'INVALID_SOCKET_COUNT' END"


def _classified(spark, sf) -> DataFrame:
    rows = read(spark, sf, "events").select("event_id", F.expr(_RAW).alias("value"))
    return records.classified(rows, _RECORD)


@query(f"SELECT event_id, {_CLASS} AS error_type FROM events")
def classify_records(spark, sf):
    return _classified(spark, sf).select("event_id", "error_type")


@query("SELECT event_id, CAST(j - 1 AS INTEGER) AS \"position\", CASE event_id % 8 WHEN 0 THEN 1.5 WHEN 3 THEN 2.0 END AS \"Average\" FROM (SELECT event_id, unnest(range(1, CASE WHEN event_id % 8 IN (0, 3) THEN 2 ELSE 1 END)) AS j FROM events)")
def variant_readings(spark, sf):
    """Entries of the records' details, by path, whatever else a record lacks."""
    return records.readings(_classified(spark, sf), "event_id")


@query(f"""SELECT {_CLASS} AS error_type, count(*) AS n, CASE {_CLASS} WHEN 'VALID' THEN 'BIGINT' WHEN 'INVALID_SOCKET_COUNT' THEN 'STRING' WHEN 'MISSING_DEVICE_ID' THEN 'BIGINT' ELSE 'BIGINT' END AS sockets FROM events WHERE event_id % 8 NOT IN (4, 5) GROUP BY ALL""")
def variant_drift(spark, sf):
    """The merged shape of each class's records: the type that the socket count has in it."""
    found = records.drift(_classified(spark, sf), "error_type")
    return found.select("error_type", "n", F.regexp_extract("shape", "socket_count: (\\w+)", 1).alias("sockets"))


@query(f"SELECT {_CLASS} = 'VALID' AS valid, count(*) AS n FROM events GROUP BY 1")
def valid_invalid_split(spark, sf):
    return _classified(spark, sf).groupBy((F.col("error_type") == "VALID").alias("valid")).agg(F.count("*").alias("n"))


@query(f"""SELECT event_id, {_CLASS} AS error_type, {_CLASS} = 'INVALID_SOCKET_COUNT' AND event_id % 8 = 1 AS recovered,
CASE WHEN event_id % 8 = 1 THEN 'retry' ELSE 'failure' END AS route, CASE WHEN event_id % 8 IN (1, 2) THEN 4 WHEN event_id % 8 = 6 THEN 2 END AS sockets FROM events WHERE event_id % 8 <> 0""")
def dlq_repair_route(spark, sf):
    bad = _classified(spark, sf).where("error_type <> 'VALID'").withColumn("attempts", F.lit(0))
    return telemetry.route(bad).select("event_id", "error_type", "recovered", "route", "sockets")


@query(f"SELECT event_id, {_CLASS} AS error_type, {_RAW} AS original_record FROM events WHERE event_id % 8 <> 0")
def dlq_envelope(spark, sf):
    bad = _classified(spark, sf).where("error_type <> 'VALID'").withColumn("topic", F.col("event_id").cast("string"))
    made = telemetry.envelope(bad, "raw", "error_type", F.lit("2026-01-01").cast("timestamp"))
    fields = F.from_json("value", "error_type string, original_record string, topic string")
    return made.select(fields.alias("v")).select(F.col("v.topic").cast("bigint").alias("event_id"), "v.error_type", "v.original_record")


# the store


@query("""SELECT user_id, event_type, day, event_id, value FROM (SELECT user_id, event_type, CAST(ts AS DATE)::VARCHAR AS day, event_id, value, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY b DESC, event_id DESC) AS rn
FROM (SELECT *, 0 AS b FROM events WHERE event_id % 3 <> 2 UNION ALL SELECT *, 1 AS b FROM events WHERE event_id % 3 <> 0)) WHERE rn = 1""")
def store_merge_updates(spark, sf):
    rows = read(spark, sf, "events").select("user_id", "event_type", F.to_date("ts").cast("string").alias("day"), "event_id", "value")
    store = Store(spark, scratch(spark, "store"), ["user_id", "event_type", "day"], ["day"])
    store.merge(rows.where("event_id % 3 <> 2"), ["event_id"])
    store.merge(rows.where("event_id % 3 <> 0"), ["event_id"])
    store.optimize("user_id")
    return store.read().select("user_id", "event_type", "day", "event_id", "value")


@query("""WITH f AS (SELECT user_id, event_type, max(event_id) AS event_id FROM events WHERE event_id % 3 <> 2 GROUP BY ALL), s AS (SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY ALL)
SELECT * FROM f UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.user_id = s.user_id AND f.event_type = s.event_type)""")
def store_insert_only(spark, sf):
    rows = read(spark, sf, "events").select("user_id", "event_type", "event_id")
    store = Store(spark, scratch(spark, "store"), ["user_id", "event_type"])
    store.merge(rows.where("event_id % 3 <> 2"), ["event_id"])
    store.merge(rows, ["event_id"], update=False)
    return store.read()


@query("SELECT version, operation, added FROM (VALUES (0, 'create', true), (1, 'append', true), (2, 'zorder', true)) v(version, operation, added)")
def store_history(spark, sf):
    rows = read(spark, sf, "customer")
    store = Store(spark, scratch(spark, "store"), ["c_custkey"])
    store.create(rows.where("c_custkey % 2 = 0"))
    store.append(rows.where("c_custkey % 2 = 1"))
    store.zorder("c_nationkey", "c_acctbal")
    store.vacuum(0)
    assert store.read().count() == rows.count()
    return store.history().select(F.col("version").cast("int").alias("version"), "operation", F.expr("n_added > 0").alias("added"))


@query("""WITH e AS (SELECT user_id, event_type, CAST(date_trunc('hour', ts) AS VARCHAR) AS h, CAST(floor(4 * (epoch(ts) - lo) / (hi - lo + 1)) AS INTEGER) AS q FROM events, (SELECT min(epoch(ts)) AS lo, max(epoch(ts)) AS hi FROM events)),
f AS (SELECT unnest([1, 2, 3]) AS file)
SELECT file, CAST((SELECT count(*) FROM e WHERE q IN (file - 1, file)) AS BIGINT) AS rows_in, CAST((SELECT count(*) FROM (SELECT DISTINCT user_id, event_type, h FROM e WHERE q <= file)) AS BIGINT) AS rows_after FROM f""")
def rolling_window_merge(spark, sf):
    """Files that each overlap the one before by half, merged in turn: rows of a file and of the table after it. Finished files are not merged again."""
    events = read(spark, sf, "events")
    limits = events.agg(F.min(F.unix_micros("ts")).alias("lo"), F.max(F.unix_micros("ts")).alias("hi"))
    quarter = F.floor(4 * (F.unix_micros("ts") - F.col("lo")) / (F.col("hi") - F.col("lo") + 1_000_000)).cast("int")
    rows = events.crossJoin(F.broadcast(limits)).select("user_id", "event_type", F.date_trunc("hour", "ts").cast("string").alias("h"), F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", quarter.alias("q"))
    store = Store(spark, scratch(spark, "store"), ["user_id", "event_type", "h", "day"], ["day"])
    progress, found = sinks.Progress(spark, scratch(spark, "progress") + "/state.json"), []
    for file in (1, 2, 3, 2):
        if str(file) not in progress.load()["completed"]:
            numbers = store.numbers(store.merge(rows.where(F.col("q").isin(file - 1, file)).drop("q"), ["event_id"]))
            progress.complete(str(file), numbers["rows_in"])
            found.append((file, numbers["rows_in"], store.read().count()))
    return spark.createDataFrame(found, "file int, rows_in long, rows_after long")


@query("SELECT user_id AS k, arg_max(event_type, event_id) AS place, max(event_id) AS event_id FROM events GROUP BY user_id")
def store_key_moves(spark, sf):
    """Devices that move from one partition to another stay one row each."""
    rows = read(spark, sf, "events").select(F.col("user_id").alias("k"), F.col("event_type").alias("place"), "event_id")
    store = Store(spark, scratch(spark, "store"), ["k"], ["place"])
    store.merge(rows.where("event_id % 3 = 0"), ["event_id"], newer_only="event_id")
    store.merge(rows.where("event_id % 3 = 1"), ["event_id"], newer_only="event_id")
    store.merge(rows.where("event_id % 3 = 2"), ["event_id"], newer_only="event_id")
    return store.read()


def merge_days(spark, devices: int, days: int) -> list[tuple[str, int, int]]:
    """Daily files of a week each, generated and merged into one table: file, its rows, and rows of the table after it."""
    store = Store(spark, scratch(spark, "store"), schemas.LAKE_KEY, ["partition_date"])
    progress = sinks.Progress(spark, scratch(spark, "progress") + "/state.json")
    rows = []
    for day, batch in generate.daily_files(spark, devices, "2026-01-01", days).items():
        if day not in progress.load()["completed"]:
            n = store.numbers(store.merge(batch, ["file_date"]))["rows_in"]
            progress.complete(day, n)
            rows.append((day, n, store.read().count()))
    assert rows[-1][2] == quality.expected_unique(devices, days)
    return rows


# streams

#: Rows of a file that a stream reads.
FILE_ROWS = 250_000
#: Files of a micro-batch whose rows are kept until both sinks have them.
FILES = 24


def landed(rows: DataFrame, path: str, parts: int, *order: str, kind: str = "parquet", folder: str | None = None) -> int:
    """rows as files of so many equal deliveries, in order of columns if there are any. Returns the files of a delivery: more of them with more rows, so no task writes or reads a share of the table.

    folder: a name by which each delivery has a folder of its own.
    """
    each = max(1, -(-rows.count() // (parts * FILE_ROWS)))
    dealt = rows.repartitionByRange(parts * each, *order).sortWithinPartitions(*order) if order else rows.repartition(parts * each)
    writer = dealt.withColumn(folder, F.spark_partition_id() % parts).write.partitionBy(folder) if folder else dealt.write
    writer.mode("append").format(kind).save(path)
    return each


def _as_files(spark, sf) -> tuple[str, str, int]:
    path = scratch(spark, "stream")
    rows = read(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    each = landed(rows, path, 3)
    return path, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double", each


@query("SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY ALL")
def stream_foreach_upsert(spark, sf):
    path, schema, each = _as_files(spark, sf)
    store = Store(spark, scratch(spark, "store"), ["user_id", "event_type"])
    stream = jobs.files(spark, path, schema, per_trigger=each).select("user_id", "event_type", "event_id")

    def keep_newest(df, _):
        if not df.isEmpty():
            store.merge(df, ["event_id"], newer_only="event_id")

    stream.writeStream.foreachBatch(keep_newest).option("checkpointLocation", scratch(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return store.read()


@query(f"SELECT strftime(date_trunc('hour', ts), {S}) AS window_start, user_id, round(avg(value), 6) AS mean_value, count(*) AS n FROM events GROUP BY date_trunc('hour', ts), user_id")
def stream_tumbling_hour(spark, sf):
    """Every update of a window goes to a table by key, so what is read last is the whole window."""
    path, schema, each = _as_files(spark, sf)
    store = Store(spark, scratch(spark, "store"), ["window_start", "user_id"])
    windows = jobs.by_window(jobs.files(spark, path, schema, per_trigger=3 * each), "ts", "1 hour", ["user_id"], [F.avg("value").alias("mean_value"), F.count("*").alias("n")], late="400 days")
    jobs.into_store(windows, store, ["n"], scratch(spark, "checkpoint"), compact_every=0).awaitTermination()
    return store.read().select(stamp("window_start").alias("window_start"), "user_id", F.round("mean_value", 6).alias("mean_value"), "n")


@query(f"SELECT CASE WHEN {_CLASS} = 'VALID' THEN 'good' ELSE 'bad' END AS sink, count(*) AS n FROM events GROUP BY 1")
def stream_split_sinks(spark, sf):
    path, good, bad = (scratch(spark, n) for n in ("raw", "good", "bad"))
    landed(read(spark, sf, "events").select(F.expr(_RAW).alias("value")), path, 2)
    parsed = jobs.parse(jobs.files(spark, path, "value string", per_trigger=FILES), _RECORD)  # so that what a micro-batch keeps is bounded
    jobs.split_sinks(parsed, good, bad, scratch(spark, "checkpoint")).awaitTermination()
    count = lambda p, name: spark.read.parquet(p).agg(F.lit(name).alias("sink"), F.count("*").alias("n"))
    return count(good, "good").unionAll(count(bad, "bad"))


# health

_H = "(SELECT event_id, user_id, hour(ts) AS h, value, value / 100 - 0.5::DOUBLE AS score FROM events)"


@query(f"""WITH r AS {_H}, b AS (SELECT min(value) AS lo, max(value) AS hi, avg(value) AS av, min(score) AS sl, max(score) AS sh FROM r), x AS (SELECT user_id, h, avg(value) AS e FROM r GROUP BY ALL),
c AS (SELECT event_id, greatest(0.0::DOUBLE, least(100.0::DOUBLE, 100 * (score - sl) / (sh - sl))) AS ahc, greatest(0.0::DOUBLE, least(100.0::DOUBLE, 100 * (1 - abs(value - av) / (hi - lo)))) AS dhc, greatest(0.0::DOUBLE, least(100.0::DOUBLE, 100 * (1 - abs(value - e) / (hi - lo)))) AS tcc FROM r JOIN x USING (user_id, h), b),
s AS (SELECT *, 0.5::DOUBLE * ahc + 0.3::DOUBLE * dhc + 0.2::DOUBLE * tcc AS t FROM c)
SELECT event_id, round(ahc, 4) AS ahc, round(dhc, 4) AS dhc, round(tcc, 4) AS tcc, round(t, 4) AS health_score, CASE WHEN t >= 90 THEN 'Healthy' WHEN t >= 70 THEN 'Warning' WHEN t >= 50 THEN 'Degraded' ELSE 'Critical' END AS health_status FROM s""")
def health_score(spark, sf):
    df = read(spark, sf, "events").select("event_id", F.col("user_id").alias("device_id"), F.hour("ts").alias("hour_of_day"), F.col("value").alias("avg_metric_value"), F.expr("value / 100 - 0.5D").alias("anomaly_score"))
    return health.health(df).select("event_id", *(F.round(c, 4).alias(c) for c in ("ahc", "dhc", "tcc", "health_score")), "health_status")


@query("""SELECT l_orderkey, l_linenumber, hour(l_shipdate) AS hour_of_day, CAST(isodow(l_shipdate) - 1 AS BIGINT) AS day_of_week, round(epoch(date_trunc('second', l_shipdate) - TIMESTAMP '1992-01-01 06:00:00') / 3600, 6) AS uptime_hours,
CAST(floor(epoch(date_trunc('second', l_shipdate) - TIMESTAMP '1995-06-17 12:00:00') / 86400) AS BIGINT) AS days_since_maintenance, round(l_quantity - l_tax, 6) AS temperature_delta, round(l_extendedprice / (l_quantity + 1), 6) AS fan_temp_ratio,
round(l_extendedprice / nullif(l_linenumber - 1, 0), 6) AS power_per_socket, round(l_discount / (l_tax + 1), 6) AS cpu_memory_ratio FROM lineitem""")
def feature_engineering(spark, sf):
    df = read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("metric_time"), F.lit("1992-01-01 06:00:00").alias("last_boot_time"), F.lit("1995-06-17 12:00:00").alias("last_maintenance_date"), F.col("l_quantity").alias("cpu_temperature"), F.col("l_tax").alias("amb_temp"),
        F.col("l_extendedprice").alias("avg_metric_value"), F.col("l_extendedprice").alias("max_metric_value"), F.col("l_tax").alias("min_metric_value"), F.col("l_extendedprice").alias("fan_speed_rpm"), (F.col("l_linenumber") - 1).alias("socket_count"),
        F.col("l_discount").alias("cpu_utilization"), F.col("l_tax").alias("memory_utilization"), F.col("l_tax").alias("disk_utilization"),
    )
    found = health.features(df)
    rounded = ("uptime_hours", "temperature_delta", "fan_temp_ratio", "power_per_socket", "cpu_memory_ratio")
    return found.select("l_orderkey", "l_linenumber", F.col("hour_of_day").cast("bigint").alias("hour_of_day"), F.col("day_of_week").cast("bigint").alias("day_of_week"), "days_since_maintenance", *(F.round(c, 6).alias(c) for c in rounded))


@query("""WITH f AS (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS b, CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS s FROM customer), m AS (SELECT quantile_cont(b, 0.5) AS md FROM f), g AS (SELECT c_custkey, coalesce(b, md) AS b, s FROM f, m),
t AS (SELECT avg(b) AS mean, stddev_pop(b) AS sd FROM g), k AS (SELECT s, dense_rank() OVER (ORDER BY s) - 1 AS code FROM (SELECT DISTINCT s FROM f WHERE s IS NOT NULL)), top AS (SELECT s FROM f WHERE s IS NOT NULL GROUP BY s ORDER BY count(*) DESC, s LIMIT 1)
SELECT c_custkey, round((b - mean) / sd, 6) AS x_balance, code::DOUBLE AS x_segment FROM g, t, top JOIN k ON k.s = coalesce(g.s, top.s)""")
def preprocess_features(spark, sf):
    df = read(spark, sf, "customer").selectExpr("c_custkey", "CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS balance", "CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS segment")
    out = health.Preprocessor.fit(df, ["balance"], ["segment"]).transform(df)
    return out.select("c_custkey", F.round("x_balance", 6).alias("x_balance"), "x_segment")


@query("SELECT round(quantile_cont(value, 0.2), 6) AS threshold, min(value) AS min_score, max(value) AS max_score, count(*) FILTER (WHERE value < (SELECT quantile_cont(value, 0.2) FROM events)) AS anomalies FROM events")
def score_threshold(spark, sf):
    events = read(spark, sf, "events")
    limits = health.threshold(events, "value")
    flagged = events.agg(F.count_if(health.prediction(F.col("value"), F.lit(limits["threshold"])) == -1).alias("anomalies"))
    return flagged.select(F.lit(round(limits["threshold"], 6)).alias("threshold"), F.lit(limits["min_score"]).alias("min_score"), F.lit(limits["max_score"]).alias("max_score"), "anomalies")


@query()
def isolation_forest_scores(spark, sf):
    df = read(spark, sf, "events").select("event_id", "value", F.hour("ts").cast("double").alias("hour"))
    return health.IsolationForest().fit(df, ["value", "hour"], ["event_id"]).score(df)
