"""Scans, projections, joins, aggregates, windows, sorts and set operations over the test tables.

events stand for readings (user_id the device, ts the time), orders with lineitem for reports with
their readings, customer, nation and region for the device and location registries.
"""

from functools import reduce

from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import quality, series, telemetry
from ..sources import sinks, tables
from .registry import S, query, read, stamp

# scans and filters


@query(f"SELECT event_id, user_id, strftime(ts, {S}) AS at, value FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'")
def range_scan_half_open(spark, sf):
    return tables.time_range(read(spark, sf, "events"), "ts", "2024-01-05", "2024-01-12").select("event_id", "user_id", stamp("ts").alias("at"), "value")


@query(f"SELECT event_id, strftime(ts, {S}) AS at FROM events WHERE ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-12'")
def range_scan_right_closed(spark, sf):
    return tables.time_range(read(spark, sf, "events"), "ts", "2024-01-05", "2024-01-12", "right").select("event_id", stamp("ts").alias("at"))


@query("SELECT event_id, user_id, event_type FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def device_list_filter(spark, sf):
    ids = read(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    return read(spark, sf, "events").join(ids, "user_id", "left_semi").select("event_id", "user_id", "event_type")


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01' AND l_discount >= 0.05")
def typed_projection(spark, sf):
    schema = "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp"
    df = tables.typed(spark, f"{sf}/lineitem.parquet", schema)
    return df.where((F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp")) & (F.col("l_discount") >= 0.05)).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("SELECT p_partkey, CAST(p_size AS DOUBLE) AS watts, TRY_CAST(nullif(regexp_extract(trim(p_name), '^(-?[0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE) AS other FROM part")
def sensor_text_parse(spark, sf):
    part = read(spark, sf, "part")
    line = F.concat_ws(" | ", "p_type", F.concat("p_size", F.lit(" Watts")), F.lit("ok"))
    return part.select("p_partkey", tables.sensor_number(line).alias("watts"), tables.sensor_number(F.concat_ws(" : ", F.lit("Name"), "p_name")).alias("other"))


@query("SELECT c_nationkey, c_mktsegment, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS devices, count(*) AS n_devices FROM customer GROUP BY ALL")
def registry_hierarchy_index(spark, sf):
    found = tables.hierarchy_index(read(spark, sf, "customer"), "c_nationkey", "c_mktsegment", device="c_custkey")
    return found.withColumn("devices", F.array_join("devices", ","))


@query("""SELECT table_name, column_name, CASE WHEN data_type LIKE 'TIMESTAMP%' OR data_type = 'DATE' THEN 'time' WHEN data_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT', 'SMALLINT') THEN 'number' ELSE 'text' END AS kind
FROM information_schema.columns WHERE table_name IN ('events', 'orders', 'nation')""")
def catalog_columns(spark, sf):
    rows = [(t, *c) for t in ("events", "orders", "nation") for c in tables.describe(read(spark, sf, t))]
    return spark.createDataFrame(rows, "table_name string, column_name string, kind string")


@query("SELECT CAST(ts AS DATE)::VARCHAR AS file_date, count(*) AS n FROM events WHERE CAST(ts AS DATE) NOT IN (SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE event_id % 10 = 0 AND user_id < 20) GROUP BY 1")
def resume_filter(spark, sf):
    events = read(spark, sf, "events").withColumn("day", F.to_date("ts"))
    done = events.where("event_id % 10 = 0 AND user_id < 20").select("day").distinct()
    return events.join(done, "day", "left_anti").groupBy(F.col("day").cast("string").alias("file_date")).agg(F.count("*").alias("n"))


@query("SELECT event_id, value FROM events WHERE ts IS NOT NULL AND event_type = 'click' AND value < 50")
def predicate_filters(spark, sf):
    return read(spark, sf, "events").where("ts IS NOT NULL AND event_type = 'click' AND value < 50").select("event_id", "value")


# projections and conditions


@query("SELECT o_orderkey, o_orderstatus AS \"Status\", o_totalprice AS \"Average\", upper(o_orderpriority) AS \"Name\" FROM orders")
def struct_rename_expand(spark, sf):
    data = F.struct(F.col("o_orderstatus").alias("Status"), F.col("o_totalprice").alias("Average"), F.upper("o_orderpriority").alias("Name"))
    return read(spark, sf, "orders").select("o_orderkey", data.alias("data")).select("o_orderkey", "data.*")


@query(f"SELECT event_id, strftime(ts, {S}) AS metric_time, strftime(ts, '%Y-%m-%d') AS partition_date FROM events")
def default_time_columns(spark, sf):
    df = read(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("ts")).alias("window_start"), F.col("ts").cast("string").alias("created_at"))
    return telemetry.add_partition_columns(df, F.lit("2000-01-01").cast("timestamp")).select("event_id", stamp("metric_time").alias("metric_time"), "partition_date")


@query("""SELECT event_id, coalesce(TRY_CAST(event_type AS DOUBLE), 0) AS number, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS name, CAST(user_id AS INTEGER) AS device,
CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS error_reason, '' AS absent, 0 AS pcie FROM events""")
def typed_fill(spark, sf):
    df = read(spark, sf, "events").select("event_id", F.col("event_type").alias("number"), F.expr("CASE WHEN event_id % 3 <> 0 THEN event_type END").alias("name"), F.col("user_id").cast("string").alias("device"), F.expr("CASE WHEN event_id % 3 <> 0 THEN event_type END").alias("error_reason"))
    return telemetry.prepare(df, {"event_id": "bigint", "number": "double", "name": "string", "device": "int", "error_reason": "string", "absent": "string", "pcie": "int"}, nullable=["error_reason"])


@query("""SELECT event_id, CASE WHEN value >= 90 THEN 'Healthy' WHEN value >= 70 THEN 'Warning' WHEN value >= 50 THEN 'Degraded' ELSE 'Critical' END AS status,
CASE WHEN value >= 90 THEN 'Healthy' WHEN value >= 50 THEN 'Warning' ELSE 'Degraded' END AS training_status, CASE WHEN value < 20 THEN -1 ELSE 1 END AS prediction,
CASE WHEN value < 20 THEN 'Anomaly' ELSE 'Normal' END AS label FROM events""")
def status_labels(spark, sf):
    from ..operators import health

    v = F.col("value")
    df = read(spark, sf, "events").select("event_id", health.status(v).alias("status"), health.training_status(v).alias("training_status"), health.prediction(v, F.lit(20.0)).alias("prediction"))
    return df.withColumn("label", F.element_at(F.create_map(F.lit(1), F.lit("Normal"), F.lit(-1), F.lit("Anomaly")), F.col("prediction")))


@query("SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN 'critical' WHEN c_custkey % 5 = 0 THEN 'warning' ELSE 'normal' END AS severity FROM customer WHERE c_nationkey = 3 AND c_mktsegment <> 'MACHINERY'")
def hierarchy_severity(spark, sf):
    k = F.col("c_custkey")
    severity = F.when(F.pmod(k, F.lit(13)) == 0, "critical").when(F.pmod(k, F.lit(5)) == 0, "warning").otherwise("normal")
    return read(spark, sf, "customer").where("c_nationkey = 3 AND c_mktsegment <> 'MACHINERY'").select("c_custkey", severity.alias("severity"))


# joins


@query("SELECT c.c_custkey, h.h AS hour, count(e.event_id) AS n FROM (SELECT c_custkey FROM customer) c CROSS JOIN (SELECT unnest(range(0, 24)) AS h) h LEFT JOIN events e ON e.user_id = c.c_custkey AND hour(e.ts) = h.h GROUP BY ALL")
def cross_time_grid(spark, sf):
    hours = spark.range(24).select(F.col("id").alias("hour"))
    grid = read(spark, sf, "customer").select("c_custkey").crossJoin(F.broadcast(hours))
    counts = read(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey"), F.hour("ts").cast("bigint").alias("hour")).agg(F.count("*").alias("n"))
    return grid.join(counts, ["c_custkey", "hour"], "left").na.fill(0, ["n"])


@query("SELECT e.event_id, round(e.value - p.base, 6) AS excess FROM events e LEFT JOIN (SELECT hour(ts) AS h, avg(value) AS base FROM events WHERE event_type = 'view' GROUP BY 1) p ON p.h = hour(e.ts)")
def broadcast_profile_join(spark, sf):
    events = read(spark, sf, "events").withColumn("h", F.hour("ts"))
    profile = events.where("event_type = 'view'").groupBy("h").agg(F.avg("value").alias("base"))  # 24 rows at most
    return events.join(F.broadcast(profile), "h", "left").select("event_id", F.round(F.col("value") - F.col("base"), 6).alias("excess"))


@query("""SELECT o_orderkey, coalesce(c_mktsegment, 'unknown') AS segment, coalesce(n_name, 'nowhere') AS location FROM orders
LEFT JOIN (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 11 <> 0) ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""")
def hydrate_left_defaults(spark, sf):
    customer = read(spark, sf, "customer").where("c_custkey % 11 <> 0").selectExpr("c_custkey AS device", "CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS segment", "c_nationkey AS n_nationkey")
    registry = customer.join(F.broadcast(read(spark, sf, "nation")), "n_nationkey", "left").select("device", "segment", F.col("n_name").alias("location"))
    orders = read(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("device"))
    return telemetry.hydrate(orders, registry, "device", {"segment": "unknown", "location": "nowhere"}).drop("device")


@query(f"SELECT user_id, strftime(max(ts), {S}) AS last_time, count(*) AS n FROM events GROUP BY user_id")
def last_time_and_rows(spark, sf):
    return read(spark, sf, "events").groupBy("user_id").agg(stamp(F.max("ts")).alias("last_time"), F.count("*").alias("n"))


@query("SELECT e.event_id, round(abs(e.value - m.m), 6) AS distance FROM events e JOIN (SELECT user_id, hour(ts) AS h, avg(value) AS m FROM events GROUP BY ALL) m ON m.user_id = e.user_id AND m.h = hour(e.ts)")
def hour_of_day_baseline(spark, sf):
    events = read(spark, sf, "events").withColumn("h", F.hour("ts"))
    base = events.groupBy("user_id", "h").agg(F.avg("value").alias("m"))
    return events.join(base, ["user_id", "h"]).select("event_id", F.round(F.abs(F.col("value") - F.col("m")), 6).alias("distance"))


@query("SELECT DISTINCT user_id FROM events WHERE event_id % 7 = 0 AND user_id NOT IN (SELECT user_id FROM events WHERE event_id % 40 = 1)")
def anti_new_devices(spark, sf):
    events = read(spark, sf, "events")
    known = events.where("event_id % 40 = 1").select("user_id")
    return events.where("event_id % 7 = 0").select("user_id").distinct().join(known, "user_id", "left_anti")


@query("SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY user_id HAVING min(event_id) >= 60)")
def semi_backfill_rows(spark, sf):
    events = read(spark, sf, "events")
    fresh = events.groupBy("user_id").agg(F.min("event_id").alias("m")).where("m >= 60")
    return events.join(fresh, "user_id", "left_semi").select("event_id", "user_id")


@query(f"SELECT strftime(h, {S}) AS hour FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-07', INTERVAL 1 HOUR)) AS h) WHERE h NOT IN (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'purchase')")
def anti_missing_hours(spark, sf):
    hours = spark.sql("SELECT explode(sequence(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-07', INTERVAL 1 HOUR)) AS h")
    have = read(spark, sf, "events").where("event_type = 'purchase'").select(F.date_trunc("hour", "ts").alias("h")).distinct()
    return hours.join(have, "h", "left_anti").select(stamp("h").alias("hour"))


_MARKS = "SELECT user_id, max(ts) AS mark FROM events WHERE event_id % 3 = 0 AND user_id % 2 = 0 GROUP BY 1"


@query(f"SELECT event_id, e.user_id FROM events e LEFT JOIN ({_MARKS}) m ON m.user_id = e.user_id WHERE ts > coalesce(mark, TIMESTAMP '1970-01-01')")
def watermark_incremental(spark, sf):
    events = read(spark, sf, "events")
    marks = events.where("event_id % 3 = 0 AND user_id % 2 = 0").groupBy("user_id").agg(F.max("ts").alias("mark"))
    return telemetry.newer_than(events, marks, "user_id", "ts", "mark").select("event_id", "user_id")


@query(f"""SELECT user_id, strftime(coalesce(n.t, o.t), {S}) AS last_time, coalesce(o.c, 0) + coalesce(n.c, 0) AS rows_loaded
FROM (SELECT user_id, max(ts) AS t, count(*) AS c FROM events WHERE event_id % 3 = 0 GROUP BY 1) o FULL JOIN (SELECT user_id, max(ts) AS t, count(*) AS c FROM events WHERE event_id % 3 = 1 AND user_id % 2 = 0 GROUP BY 1) n USING (user_id)""")
def upsert_watermarks(spark, sf):
    events = read(spark, sf, "events")
    old = events.where("event_id % 3 = 0").groupBy("user_id").agg(F.max("ts").alias("last_time"), F.count("*").alias("rows_loaded"))
    return telemetry.merge_marks(old, events.where("event_id % 3 = 1 AND user_id % 2 = 0"), "user_id", "ts").withColumn("last_time", stamp("last_time"))


_HALVES = "(SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 3 <> 0)", "(SELECT c_custkey, 'NEW' AS c_mktsegment, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_custkey % 2 = 0)"


def _halves(spark, sf):
    customer = read(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return customer.where("c_custkey % 3 <> 0"), customer.where("c_custkey % 2 = 0").select("c_custkey", F.lit("NEW").alias("c_mktsegment"), F.expr("c_acctbal + 1").alias("c_acctbal"))


@query(f"SELECT * FROM {_HALVES[0]} t WHERE c_custkey NOT IN (SELECT c_custkey FROM {_HALVES[1]} s) UNION ALL SELECT * FROM {_HALVES[1]} s")
def merge_update_all(spark, sf):
    return telemetry.upsert(*_halves(spark, sf), ["c_custkey"])


@query(f"SELECT * FROM {_HALVES[0]} t UNION ALL SELECT * FROM {_HALVES[1]} s WHERE c_custkey NOT IN (SELECT c_custkey FROM {_HALVES[0]} t)")
def merge_insert_only(spark, sf):
    return telemetry.upsert(*_halves(spark, sf), ["c_custkey"], update=False)


_SPLIT = "SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n FROM events {} GROUP BY ALL"


@query(f"""SELECT user_id, strftime(hour, {S}) AS hour, a.n AS left_value, b.n AS right_value FROM ({_SPLIT.format("WHERE event_id % 50 <> 7")}) a FULL JOIN ({_SPLIT.format("WHERE event_id % 60 <> 1")}) b USING (user_id, hour) WHERE a.n IS NULL OR b.n IS NULL OR a.n <> b.n""")
def rollup_mismatch_full_outer(spark, sf):
    events = read(spark, sf, "events").withColumn("hour", F.date_trunc("hour", "ts"))
    count = lambda rule: events.where(rule).groupBy("user_id", "hour").agg(F.count("*").alias("n"))
    return quality.mismatches(count("event_id % 50 <> 7"), count("event_id % 60 <> 1"), ["user_id", "hour"], "n").withColumn("hour", stamp("hour"))


# aggregates


@query("SELECT user_id, event_type, count(*) AS dup_count FROM events GROUP BY ALL HAVING count(*) > 1 ORDER BY dup_count DESC, user_id, event_type LIMIT 20")
def duplicate_keys(spark, sf):
    return quality.duplicates(read(spark, sf, "events"), ["user_id", "event_type"])


@query("SELECT count(*) FILTER (WHERE c_custkey % 9 = 0 OR c_name = '') AS empty_name, count(*) FILTER (WHERE c_mktsegment = '') AS empty_c_mktsegment FROM customer")
def empty_key_counts(spark, sf):
    df = read(spark, sf, "customer").withColumn("name", F.expr("CASE WHEN c_custkey % 9 <> 0 THEN c_name END"))
    return quality.empties(df, ["name", "c_mktsegment"])


@query(f"SELECT count(*) AS total_rows, strftime(min(ts), {S}) AS earliest, strftime(max(ts), {S}) AS latest, count(DISTINCT user_id) AS devices, count(DISTINCT event_type) AS kinds FROM events")
def data_range_summary(spark, sf):
    return read(spark, sf, "events").agg(F.count("*").alias("total_rows"), stamp(F.min("ts")).alias("earliest"), stamp(F.max("ts")).alias("latest"), F.count_distinct("user_id").alias("devices"), F.count_distinct("event_type").alias("kinds"))


@query("SELECT event_type, count(DISTINCT user_id) AS devices, true AS near FROM events GROUP BY 1")
def approximate_distinct(spark, sf):
    """Exact counts, and whether the sketch is within five of its standard errors."""
    # each pair once first: beside countDistinct in one aggregate every pair would have a sketch of its own
    pairs = read(spark, sf, "events").select("event_type", "user_id").distinct()
    counts = pairs.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("n"), F.count("user_id").alias("devices"))
    return counts.select("event_type", "devices", (F.abs(F.col("n") - F.col("devices")) <= 0.1 * F.col("devices")).alias("near"))


@query("SELECT count(*) AS n_rows, round(avg(value), 6) AS mean_value, count(*) > 0 AND avg(value) <> 0 AS passed FROM events")
def pipeline_guard(spark, sf):
    return quality.guard(read(spark, sf, "events"), "value").withColumn("mean_value", F.round("mean_value", 6))


@query("""SELECT round(min(value), 6) AS value_min, round(max(value), 6) AS value_max, round(avg(value), 6) AS value_mean, round(quantile_cont(value, 0.5), 6) AS value_p50,
round(quantile_cont(value, 0.95), 6) AS value_p95, round(quantile_cont(value, 0.99), 6) AS value_p99 FROM events""")
def latency_percentiles(spark, sf):
    df = quality.latencies(read(spark, sf, "events"), ["value"])
    return df.select(*(F.round(c, 6).alias(c) for c in df.columns))


@query("""SELECT component, round(avg(t), 6) AS mean_time, round(quantile_cont(t, 0.95), 6) AS p95_time, round(100 * sum(t) / sum(w), 6) AS percent
FROM (SELECT 'merge' AS component, l_extendedprice * (1 - l_discount) AS t, l_extendedprice AS w FROM lineitem UNION ALL SELECT 'rest', l_extendedprice * l_discount, l_extendedprice FROM lineitem) GROUP BY component""")
def breakdown_percent(spark, sf):
    df = quality.breakdown(read(spark, sf, "lineitem"), {"merge": F.expr("l_extendedprice * (1 - l_discount)"), "rest": F.expr("l_extendedprice * l_discount")}, F.col("l_extendedprice"))
    return df.select("component", *(F.round(c, 6).alias(c) for c in ("mean_time", "p95_time", "percent")))


@query("SELECT event_id, value FROM events WHERE value > (SELECT quantile_cont(value, 0.99) FROM events)")
def outliers_p99(spark, sf):
    return quality.outliers(read(spark, sf, "events"), "value").select("event_id", "value")


@query(f"SELECT strftime(date_trunc('hour', ts), {S}) AS hour, count(*) AS n, CAST(round(count(*) / 3600.0, 6) AS DOUBLE) AS per_second, round(coalesce(count(*)::DOUBLE / sum(value), 0), 6) AS throughput FROM events GROUP BY 1")
def throughput_by_hour(spark, sf):
    df = read(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").alias("h"))
    return df.agg(F.count("*").alias("n"), F.round(quality.throughput(F.lit(1), F.col("value")), 6).alias("throughput")).select(stamp("h").alias("hour"), "n", F.round(F.col("n") / 3600.0, 6).alias("per_second"), "throughput")


@query("SELECT event_type, CAST(ts AS DATE)::VARCHAR AS day, count(*) AS n FROM events GROUP BY ALL")
def partition_statistics(spark, sf):
    return read(spark, sf, "events").groupBy("event_type", F.to_date("ts").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS tp, count(*) FILTER (WHERE quality <> 1 AND toxic = 1) AS fp, count(*) FILTER (WHERE quality = 1 AND toxic <> 1) AS fn, count(*) FILTER (WHERE quality <> 1 AND toxic <> 1) AS tn FROM labels)
SELECT tp, fp, fn, tn, round((tp + tn)::DOUBLE / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS "precision", round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def confusion_matrix(spark, sf):
    df = quality.confusion(read(spark, sf, "labels"), F.expr("quality = 1"), F.expr("toxic = 1"))
    return df.select("tp", "fp", "fn", "tn", *(F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")))


@query("SELECT count(*) FILTER (WHERE value < 50) AS critical, count(*) FILTER (WHERE value >= 50 AND value < 70) AS degraded, count(*) FILTER (WHERE value >= 70 AND value < 90) AS warning, count(*) FILTER (WHERE value >= 90) AS healthy FROM events")
def health_buckets(spark, sf):
    v = F.col("value")
    return read(spark, sf, "events").agg(F.count_if(v < 50).alias("critical"), F.count_if((v >= 50) & (v < 70)).alias("degraded"), F.count_if((v >= 70) & (v < 90)).alias("warning"), F.count_if(v >= 90).alias("healthy"))


@query("SELECT c_nationkey, c_mktsegment, count(*) AS n_devices, round(avg(c_acctbal), 4) AS mean_value FROM customer GROUP BY ALL")
def devices_per_hierarchy(spark, sf):
    return read(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n_devices"), F.round(F.avg("c_acctbal"), 4).alias("mean_value"))


# windows


@query("SELECT user_id, event_type, day, event_id, value FROM (SELECT user_id, event_type, CAST(ts AS DATE)::VARCHAR AS day, event_id, value, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def dedup_keep_latest(spark, sf):
    df = read(spark, sf, "events").select("user_id", "event_type", F.to_date("ts").cast("string").alias("day"), "ts", "event_id", "value")
    return telemetry.one_per_key(df, ["user_id", "event_type", "day"], ["ts", "event_id"]).drop("ts")


_TOP = "SELECT user_id, event_id, strftime(ts, {S}) AS at FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts {o}, event_id {o}) AS rn FROM events) WHERE rn <= 3"


@query(_TOP.format(S=S, o="DESC"))
def latest_n_per_device(spark, sf):
    return telemetry.first_rows(read(spark, sf, "events"), 3, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", stamp("ts").alias("at"))


@query(_TOP.format(S=S, o="ASC"))
def first_n_per_device(spark, sf):
    return telemetry.first_rows(read(spark, sf, "events"), 3, ["user_id"], [F.asc("ts"), F.asc("event_id")]).select("user_id", "event_id", stamp("ts").alias("at"))


@query("SELECT user_id, event_id, round(5.0::DOUBLE + 10 * coalesce((row_number() OVER w - 1)::DOUBLE / nullif(count(*) OVER (PARTITION BY user_id) - 1, 0), 0), 6) AS ramp FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def linear_ramp(spark, sf):
    return series.ramp(read(spark, sf, "events"), "user_id", "event_id", 5.0, 15.0).select("user_id", "event_id", F.round("ramp", 6).alias("ramp"))


@query("""WITH RECURSIVE n AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
r AS (SELECT user_id, event_id, k, value AS x FROM n WHERE k = 1 UNION ALL SELECT n.user_id, n.event_id, n.k, 0.7::DOUBLE * r.x + n.value FROM r JOIN n ON n.user_id = r.user_id AND n.k = r.k + 1) SELECT user_id, event_id, round(x, 6) AS x FROM r""")
def autoregressive_series(spark, sf):
    return series.autoregressive(read(spark, sf, "events"), "user_id", "event_id", "value").select("user_id", "event_id", F.round("x", 6).alias("x"))


@query("SELECT user_id, event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 6) AS x FROM events")
def random_walk_series(spark, sf):
    return series.autoregressive(read(spark, sf, "events"), "user_id", "event_id", "value", rho=1.0).select("user_id", "event_id", F.round("x", 6).alias("x"))


@query("SELECT event_type, event_id, round(sum(value) OVER (PARTITION BY event_type ORDER BY event_id), 4) AS x FROM events")
def long_walk_series(spark, sf):
    """A few long groups, each over many partitions."""
    return series.autoregressive(read(spark, sf, "events"), "event_type", "event_id", "value", rho=1.0).select("event_type", "event_id", F.round("x", 4).alias("x"))


@query("SELECT event_id, user_id, CASE WHEN lag(user_id) OVER (ORDER BY user_id, event_id) IS DISTINCT FROM user_id THEN 1 ELSE 0 END AS starts FROM events")
def group_boundaries(spark, sf):
    first = read(spark, sf, "events").groupBy("user_id").agg(F.min("event_id").alias("first"))
    return read(spark, sf, "events").join(first, "user_id").select("event_id", "user_id", F.when(F.col("event_id") == F.col("first"), 1).otherwise(0).alias("starts"))


# sorts and sets


@query(f"SELECT event_id, strftime(ts, {S}) AS at, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 50")
def top_k_recent(spark, sf):
    return read(spark, sf, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(50).select("event_id", stamp("ts").alias("at"), "value")


@query("SELECT l_extendedprice AS x, l_quantity AS y, l_returnflag AS color FROM lineitem ORDER BY l_extendedprice DESC, l_quantity DESC, l_returnflag LIMIT 100")
def dynamic_top_k(spark, sf):
    return read(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("x"), F.col("l_quantity").alias("y"), F.col("l_returnflag").alias("color")).orderBy(F.desc("x"), F.desc("y"), "color").limit(100)


@query("SELECT DISTINCT user_id FROM events ORDER BY user_id")
def distinct_devices(spark, sf):
    return read(spark, sf, "events").select("user_id").distinct().orderBy("user_id")


@query("""WITH h AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL)
(SELECT 'heavy' AS kind, * FROM h ORDER BY n DESC, c_nationkey, c_mktsegment LIMIT 5) UNION ALL (SELECT 'light', * FROM h ORDER BY n, c_nationkey, c_mktsegment LIMIT 5)""")
def heavy_and_light_hierarchies(spark, sf):
    counts = read(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    keys = ["c_nationkey", "c_mktsegment"]
    return counts.orderBy(F.desc("n"), *keys).limit(5).select(F.lit("heavy").alias("kind"), "*").unionAll(counts.orderBy("n", *keys).limit(5).select(F.lit("light").alias("kind"), "*"))


@query("SELECT 'events' AS table_name, count(*) AS row_count FROM events UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem")
def count_union_all(spark, sf):
    one = lambda t: read(spark, sf, t).agg(F.lit(t).alias("table_name"), F.count("*").alias("row_count"))
    return reduce(lambda a, b: a.unionAll(b), map(one, ("events", "orders", "lineitem")))


@query("SELECT event_id, user_id, NULL::DOUBLE AS value FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, user_id, value FROM events WHERE event_id % 5 = 0")
def union_by_name_missing(spark, sf):
    events = read(spark, sf, "events")
    return events.where("event_id % 2 = 0").select("user_id", "event_id").unionByName(events.where("event_id % 5 = 0").select("event_id", "user_id", "value"), allowMissingColumns=True)


@query("SELECT user_id, event_type FROM events WHERE event_id % 2 = 0 UNION SELECT user_id, event_type FROM events WHERE event_id % 3 = 0")
def union_distinct(spark, sf):
    events = read(spark, sf, "events").select("event_id", "user_id", "event_type")
    return events.where("event_id % 2 = 0 OR event_id % 3 = 0").select("user_id", "event_type").distinct()


@query("SELECT user_id FROM events WHERE event_type = 'click' EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase' AND event_id % 3 = 0")
def set_difference(spark, sf):
    events = read(spark, sf, "events")
    return events.where("event_type = 'click'").select("user_id").distinct().join(events.where("event_type = 'purchase' AND event_id % 3 = 0").select("user_id"), "user_id", "left_anti")


@query("SELECT event_id, user_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 10 DAY")
def expire_by_age(spark, sf):
    return sinks.expire(read(spark, sf, "events"), "ts", 10).select("event_id", "user_id")


@query("""WITH d AS (SELECT day, row_number() OVER (ORDER BY day) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events))
SELECT CASE WHEN r <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM events JOIN d ON day = CAST(ts AS DATE) GROUP BY 1""")
def split_by_days(spark, sf):
    train, test = sinks.split_days(read(spark, sf, "events"), "ts")
    return train.agg(F.lit("train").alias("part"), F.count("*").alias("n")).unionAll(test.agg(F.lit("test").alias("part"), F.count("*").alias("n")))


@query("SELECT conv_id, turn, CASE WHEN length(text) > 30 THEN left(text, 30) || '...' ELSE text END AS title FROM conversations WHERE role = 'user'")
def session_titles(spark, sf):
    return read(spark, sf, "conversations").where("role = 'user'").select("conv_id", "turn", scalar.shorten(F.col("text")).alias("title"))


@query("SELECT conv_id, turn, role FROM conversations WHERE conv_id NOT IN (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 4 = 0)")
def delete_cascade(spark, sf):
    talks = read(spark, sf, "conversations")
    gone = talks.where("conv_id % 4 = 0").select("conv_id").distinct()
    return talks.join(gone, "conv_id", "left_anti").select("conv_id", "turn", "role")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'Warning' ELSE o_orderstatus END AS status FROM orders")
def conditional_update(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, "Warning").otherwise(F.col("o_orderstatus")).alias("status"))


# scalar functions


@query("SELECT p_partkey, TRY_CAST(nullif(regexp_extract(p_name || ' ' || CAST(p_size AS VARCHAR) || 'GB', '(\\d+)', 1), '') AS DOUBLE) AS capacity, format('SRV-{:06d}', p_partkey) AS server, contains(p_type, 'A') AS has_a, substring(p_brand, 1, 3) AS short FROM part")
def string_functions(spark, sf):
    part = read(spark, sf, "part")
    capacity = scalar.first_number(F.concat_ws("", "p_name", F.lit(" "), "p_size", F.lit("GB")))
    return part.select("p_partkey", capacity.alias("capacity"), F.format_string("SRV-%06d", "p_partkey").alias("server"), F.contains("p_type", F.lit("A")).alias("has_a"), F.substring("p_brand", 1, 3).alias("short"))


@query("SELECT event_id, sha256(concat_ws('|', coalesce(CAST(user_id AS VARCHAR), '\\N'), coalesce(event_type, '\\N'))) AS hash FROM events")
def composite_hash(spark, sf):
    return read(spark, sf, "events").select("event_id", scalar.key_hash("user_id", "event_type").alias("hash"))


@query(f"""SELECT event_id, hour(ts) AS h, minute(ts) AS mi, isodow(ts) - 1 AS dow, dayofyear(ts) AS doy, strftime(date_trunc('hour', ts), {S}) AS hour, strftime(ts, '%Y%m%d') AS day,
strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, epoch(date_trunc('second', ts)) AS seconds, CAST(epoch(date_trunc('second', ts)) AS BIGINT) // 300 * 300 AS slot, date_diff('minute', date_trunc('day', ts), date_trunc('minute', ts)) AS minutes FROM events""")
def time_functions(spark, sf):
    t = F.col("ts")
    return read(spark, sf, "events").select(
        "event_id", F.hour(t).cast("bigint").alias("h"), F.minute(t).cast("bigint").alias("mi"), F.weekday(t).cast("bigint").alias("dow"), F.dayofyear(t).cast("bigint").alias("doy"), stamp(F.date_trunc("hour", t)).alias("hour"), F.date_format(t, "yyyyMMdd").alias("day"),
        scalar.iso(t).alias("iso"), scalar.epoch(t).alias("seconds"), scalar.floor_time(F.unix_timestamp(t), 300).alias("slot"), F.expr("timestampdiff(MINUTE, date_trunc('day', ts), ts)").alias("minutes"),
    )


@query(f"SELECT event_id, strftime(date_trunc('second', ts), {S}) AS iso_time, strftime(date_trunc('second', ts), {S}) AS slash_time, NULL::VARCHAR AS no_time FROM events")
def time_repair(spark, sf):
    t = F.col("ts")
    return read(spark, sf, "events").select("event_id", stamp(scalar.parse_time(scalar.iso(t))).alias("iso_time"), stamp(scalar.parse_time(F.date_format(t, "dd/MM/yyyy HH:mm:ss"))).alias("slash_time"), stamp(scalar.parse_time(F.col("event_type"))).alias("no_time"))


@query("SELECT event_id, round(sin(value / 14), 6) AS s, CAST(event_id % 17 AS BIGINT) AS m, floor(value)::BIGINT AS f, greatest(10.0::DOUBLE, least(60.0::DOUBLE, value)) AS clipped, round(value / nullif(user_id % 5, 0), 6) AS ratio FROM events")
def math_functions(spark, sf):
    v = F.col("value")
    return read(spark, sf, "events").select("event_id", F.round(F.sin(v / 14), 6).alias("s"), F.pmod("event_id", F.lit(17)).alias("m"), F.floor(v).alias("f"), scalar.clip(v, 10.0, 60.0).alias("clipped"), F.round(scalar.ratio(v, F.col("user_id") % 5), 6).alias("ratio"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none') AS missing FROM events")
def json_extract_props(spark, sf):
    parsed = F.from_json("props", "k bigint, none string")
    return read(spark, sf, "events").select("event_id", parsed.alias("p")).select("event_id", "p.k", F.col("p.none").alias("missing"))


@query("SELECT o_orderkey, list_extract([o_orderstatus, o_orderpriority, 'z'], 2) AS second, 'z' AS last, len(string_split(o_orderpriority, '-')) AS n, trim(string_split(o_orderpriority, '-')[1]) AS head FROM orders")
def array_map_functions(spark, sf):
    items = F.array("o_orderstatus", "o_orderpriority", F.lit("z"))
    pairs = F.create_map(F.lit("a"), F.col("o_orderpriority"))
    ids = F.transform(F.split("o_orderpriority", "-"), lambda x: F.trim(x))
    return read(spark, sf, "orders").select("o_orderkey", F.element_at(items, 2).alias("second"), F.element_at(items, -1).alias("last"), F.size(F.split(F.try_element_at(pairs, F.lit("a")), "-")).cast("bigint").alias("n"), F.element_at(ids, 1).alias("head"))


@query("SELECT user_id, k, round(sum(value)::DOUBLE, 3) AS total FROM (SELECT user_id, 'value' AS k, round(value, 3) AS value FROM events UNION ALL SELECT user_id, 'id', event_id::DOUBLE FROM events) GROUP BY ALL")
def map_explode(spark, sf):
    pairs = F.create_map(F.lit("value"), F.round("value", 3), F.lit("id"), F.col("event_id").cast("double"))
    df = read(spark, sf, "events").select("user_id", F.explode(pairs).alias("k", "v")).groupBy("user_id", "k").agg(F.sum("v").alias("total"))
    return df.withColumn("total", F.round("total", 3))
