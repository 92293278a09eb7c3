"""Readings and reports: nesting and flattening, latest rows, classification and repair, rollups."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar

# readings ---------------------------------------------------------------------------------


def first_rows(df: DataFrame, n: int, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first n rows of each group; Spark cuts every group before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def one_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The greatest row of each key by order, with partial aggregation and no window."""
    rest = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*key).agg(best.alias("_r")).select(*(F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in df.columns))


def power_detail(df: DataFrame, by: Sequence[str], time: str, value: str, low: str, high: str, *rest: str) -> DataFrame:
    """A row for each group: its readings in time order, and average, minimum and maximum; null counts as 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    entry = F.struct(F.col(time).alias("Time"), zero(value).alias("Average"), zero(low).alias("Minimum"), zero(high).alias("Peak"), *rest)
    out = df.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("PowerDetail"), F.round(F.avg(zero(value)), 2).alias("Average"), F.min(zero(low)).alias("Minimum"), F.max(zero(high)).alias("Maximum"))
    return out


def flatten(df: DataFrame, detail: str, keep: Sequence[str]) -> DataFrame:
    """A row for each reading; groups without readings vanish, as in an inner explode."""
    return df.select(*keep, F.explode(detail).alias("p")).select(*keep, "p.*")


def hydrate(df: DataFrame, registry: DataFrame, key: str, defaults: dict[str, str]) -> DataFrame:
    """The registry's attributes by key: a row's own value first, then the registry's, then the default."""
    known = registry.select(key, *(F.col(c).alias(f"_r_{c}") for c in defaults))
    joined = df.join(known, key, "left")
    values = {c: F.coalesce(*([F.col(c)] if c in df.columns else []), F.col(f"_r_{c}"), F.lit(d)) for c, d in defaults.items()}
    return joined.withColumns(values).drop(*(f"_r_{c}" for c in defaults))


# classification and repair -------------------------------------------------------------------

#: The faults that a repair may mend.
RECOVERABLE = ("INVALID_SCHEMA", "INVALID_SOCKET_COUNT")


def envelope(df: DataFrame, raw: str, error: str, at: Column) -> DataFrame:
    """Records for the dead-letter sink as JSON in value; the raw text is kept whole."""
    fields = F.struct(
        F.col(error).alias("error_type"), F.concat(F.lit("record is "), F.col(error)).alias("error_message"), F.col(raw).alias("original_record"),
        *(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ("topic", "partition", "offset")),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("failed_at"), F.lit("lakegauge").alias("pipeline"),
    )
    return df.select(F.lit(None).cast("string").alias("key"), F.to_json(fields).alias("value"))


def repaired_sockets(raw: Column) -> Column:
    """The socket count of a raw record as an integer, from a number or numeric text; else null."""
    return F.trim(F.get_json_object(raw, "$.inventory_data.socket_count")).try_cast("int")


def route(df: DataFrame, raw: str = "raw", error: str = "error_type", attempts: str = "attempts", most: int = 3) -> DataFrame:
    """df with recovered, sockets, time and route: retry only if every repair succeeds and attempts are left, else failure."""
    sockets, text = repaired_sockets(F.col(raw)), F.get_json_object(F.col(raw), "$.created_at")
    fixed = F.when(F.col(error) == "INVALID_SOCKET_COUNT", sockets.isNotNull()).otherwise(F.lit(True))
    timed = text.isNull() | scalar.parse_time(text).isNotNull()
    good = F.col(error).isin(*RECOVERABLE) & (F.trim(F.col(raw)) != "") & fixed & timed & (F.col(attempts) < most)
    return df.withColumns({"sockets": sockets, "time": scalar.parse_time(text), "recovered": F.coalesce(good, F.lit(False))}).withColumn("route", F.when(F.col("recovered"), "retry").otherwise("failure"))


def recovery_metadata(df: DataFrame, at: Column) -> Column:
    return F.to_json(F.struct(F.lit("repaired").alias("status"), F.col("error_type").alias("original_error"), F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("recovered_at")))


# refined rows ------------------------------------------------------------------------------------

#: The identity columns of a report, in the order of the refined row.
DIMENSIONS = ("device_id", "report_id", "application_customer_id", "platform_customer_id", "status", "report_type", "error_reason", "model", "tags", "location_state", "location_country", "processor_vendor", "server_generation", "location_id", "location_name", "location_city", "server_name")
#: Factors of the refined row, and seconds that its range spans.
CO2_FACTOR, ENERGY_COST_FACTOR, RANGE_SECONDS = 0.5, 1.2, 60


def refine(golden: DataFrame, inserted: Column) -> DataFrame:
    """41 columns for each device report of nested golden records, from one shuffle.

    Times are parsed before their maximum is taken, and inventory is the first that is not null by time.
    """
    flat = golden.select(*DIMENSIONS, "inventory_data", F.explode("data.PowerDetail").alias("power")).withColumn("at", scalar.parse_time(F.col("power.Time")))
    a, r = F.col, lambda f, c: F.round(f(F.col(f"power.{c}")), 2)
    early = lambda c: F.min_by(a(f"inventory_data.{c}"), F.when(a(f"inventory_data.{c}").isNotNull(), a("at")))
    grouped = flat.groupBy(*DIMENSIONS).agg(
        r(F.avg, "Average").alias("avg_metric_value"), r(F.max, "Average").alias("max_metric_value"), r(F.min, "Average").alias("min_metric_value"), r(F.avg, "AmbTemp").alias("amb_temp"),
        r(F.avg, "CpuWatts").alias("avg_cpu_watts"), F.max("power.CpuWatts").cast("double").alias("max_cpu_watts"), r(F.avg, "GpuWatts").alias("avg_gpu_watts"), r(F.avg, "Peak").alias("avg_peak_power"), r(F.max, "Peak").alias("max_peak_power"),
        F.max("at").alias("at"), early("socket_count").cast("int").alias("socket_count"), F.to_json(early("cpu_inventory")).alias("cpu_inventory"), F.to_json(early("memory_inventory")).alias("memory_inventory"),
    )
    day, text = F.date_format("at", "yyyy-MM-dd"), scalar.iso(F.col("at"))
    return grouped.select(
        *DIMENSIONS, F.col("avg_metric_value").alias("MetricValue"), F.lit("power_metric").alias("metric_id"), "cpu_inventory", "memory_inventory", F.lit(0).alias("pcie_devices_count"), "socket_count",
        "avg_metric_value", "max_metric_value", "min_metric_value", "avg_cpu_watts", "max_cpu_watts", "avg_gpu_watts", "avg_peak_power", "max_peak_power", text.alias("metric_time"),
        scalar.epoch(F.col("at")).alias("datetime"), (scalar.epoch(F.col("at")) + RANGE_SECONDS).alias("timeRangeEnd"), "amb_temp", scalar.epoch(inserted).alias("Insertiontime"), F.lit(CO2_FACTOR).alias("co2_factor"), F.lit(ENERGY_COST_FACTOR).alias("energy_cost_factor"),
        text.alias("max_metric_time"), day.alias("location_date"), day.alias("inventory_date"),
    )


# rollups ----------------------------------------------------------------------------------------


def rollup_states(df: DataFrame, dims: Sequence[str], bucket: Column, value: str, amb: str | None = None) -> DataFrame:
    """Mergeable states by dimensions and bucket."""
    ambient = [F.sum(amb).alias("sum_amb"), F.count(amb).alias("count_amb")] if amb else []
    return df.groupBy(*dims, bucket.alias("bucket")).agg(F.sum(value).alias("sum_value"), F.count(value).alias("count_value"), F.max(value).alias("max_value"), F.min(value).alias("min_value"), F.count("*").alias("record_count"), *ambient)


def merge_states(states: DataFrame, dims: Sequence[str], bucket: Column) -> DataFrame:
    """States of coarser groups."""
    how = {"sum_value": F.sum, "count_value": F.sum, "max_value": F.max, "min_value": F.min, "record_count": F.sum, "sum_amb": F.sum, "count_amb": F.sum}
    return states.groupBy(*dims, bucket.alias("bucket")).agg(*(f(c).alias(c) for c, f in how.items() if c in states.columns))


def finalize(states: DataFrame) -> DataFrame:
    """avg_value, max_value, min_value and record_count of states."""
    drop = [c for c in ("sum_value", "count_value", "sum_amb", "count_amb") if c in states.columns]
    ambient = {"avg_amb": F.try_divide("sum_amb", "count_amb")} if "sum_amb" in states.columns else {}
    return states.withColumns({"avg_value": F.try_divide("sum_value", "count_value")} | ambient).drop(*drop)


def refresh(states: DataFrame, touched: DataFrame, rows: DataFrame, dims: Sequence[str], bucket: Column, value: str) -> DataFrame:
    """States with the touched (dims, bucket) computed again from the deduplicated rows."""
    again = rollup_states(rows.withColumn("_b", bucket).join(touched.select(*dims, F.col("bucket").alias("_b")).distinct(), [*dims, "_b"], "left_semi"), dims, F.col("_b"), value)
    return states.join(touched.select(*dims, "bucket").distinct(), [*dims, "bucket"], "left_anti").unionByName(again)


# loads --------------------------------------------------------------------------------------------


def cutoff(marks: DataFrame, mark: str) -> str | None:
    """The day of the least mark that is not null, as partitions are named; None without marks. One row comes to the driver."""
    return marks.agg(F.date_format(F.min(mark), "yyyy-MM-dd").alias("d")).collect()[0]["d"]


def newer_than(df: DataFrame, marks: DataFrame, key: str, time: str, mark: str, partition: str | None = None) -> DataFrame:
    """Rows after their key's mark; keys without a mark load whole.

    With a partition column of days, those before the least mark's day are not read: a literal, so the
    scan prunes. Keys without a mark then load from that day on, and backfill() has what lies before.
    """
    epoch = F.lit("1970-01-01").cast("timestamp")
    if partition and (day := cutoff(marks, mark)):
        df = df.where(F.col(partition) >= F.lit(day).cast(df.schema[partition].dataType))
    joined = df.join(marks.select(key, F.col(mark).alias("_mark")), key, "left")
    return joined.where(F.col(time) > F.coalesce("_mark", epoch)).drop("_mark")


def backfill(df: DataFrame, marks: DataFrame, key: str, mark: str, partition: str) -> DataFrame:
    """Rows before the least mark's day of keys without a mark."""
    day = cutoff(marks, mark)
    if day is None:
        return df.limit(0)
    return df.where(F.col(partition) < F.lit(day).cast(df.schema[partition].dataType)).join(marks.where(F.col(mark).isNotNull()).select(key), key, "left_anti")


def latest_hybrid(cache: DataFrame, live: DataFrame, key: str, time: str, n: int, order: Sequence[Column], per_day: int = 288) -> DataFrame:
    """The latest n rows of each key: the cache's last n // per_day + 1 days, and live rows after the cache's newest."""
    newest = cache.agg(F.max(time).alias("t")).collect()[0]["t"]  # one row
    if newest is None:
        return first_rows(live, n, [key], order)
    days = n // per_day + 1
    recent = cache.where(F.col(time) > F.lit(newest) - F.expr(f"INTERVAL {days} DAYS"))
    return first_rows(recent.unionByName(live.where(F.col(time) > F.lit(newest)).select(*recent.columns)), n, [key], order)


def merge_marks(old: DataFrame, batch: DataFrame, key: str, time: str) -> DataFrame:
    """Marks after a load: the last time of the batch where it has the key, and rows loaded summed."""
    new = batch.groupBy(key).agg(F.max(time).alias("_t"), F.count("*").alias("_n"))
    joined = old.join(new, key, "full")
    return joined.select(key, F.coalesce("_t", "last_time").alias("last_time"), (F.coalesce("rows_loaded", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("rows_loaded"))


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], update: bool = True) -> DataFrame:
    """Rows of target and source: matched keys take the source's row, or keep their own."""
    if update:
        return target.join(source.select(*key), list(key), "left_anti").unionByName(source)
    return target.unionByName(source.join(target.select(*key), list(key), "left_anti"))


def prepare(df: DataFrame, kinds: dict[str, str], nullable: Sequence[str] = ()) -> DataFrame:
    """Exactly the columns of kinds, cast without failing; nulls and NaN become 0, '' or the epoch but in nullable ones."""
    fill = {"string": F.lit(""), "timestamp": F.lit("1970-01-01").cast("timestamp"), "boolean": F.lit(False)}

    def one(name: str, kind: str) -> Column:
        value = F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)
        if kind in ("double", "float"):
            value = F.nanvl(value, F.lit(None).cast(kind))
        return (value if name in nullable else F.coalesce(value, fill.get(kind, F.lit(0).cast(kind)))).alias(name)

    return df.select(*(one(n, k) for n, k in kinds.items()))


def add_partition_columns(df: DataFrame, now: Column) -> DataFrame:
    """metric_time and partition_date from the first time column that exists and is set."""
    times = [F.col(c).try_cast("timestamp") for c in ("metric_time", "window_start", "event_date", "created_at") if c in df.columns]
    at = F.coalesce(*times, now)
    return df.withColumns({"metric_time": at, "partition_date": F.date_format(at, "yyyy-MM-dd")})


# stream projection, hot path and exports ----------------------------------------------------------


def refine_daily(flat: DataFrame, inserted: Column, device: str = "device_id", time: str = "event_time", value: str = "value") -> DataFrame:
    """36 columns for each device and day of exploded readings; identity is the first by time that is not null."""
    day = F.to_date(time)
    rest = [c for c in (*DIMENSIONS, "socket_count") if c != device]
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(time))) if c in flat.columns else F.lit(None).cast("string")
    grouped = flat.groupBy(device, day.alias("day")).agg(F.avg(value).alias("avg"), F.max(value).alias("max"), F.min(value).alias("min"), *(first(c).alias(c) for c in rest if c in flat.columns))
    null = lambda kind: F.lit(None).cast(kind)
    kinds = {"status": "boolean", "socket_count": "int"}
    identity = [F.col(c) if c in grouped.columns else null(kinds.get(c, "string")).alias(c) for c in rest if c != "socket_count"]
    date, at = F.date_format("day", "yyyy-MM-dd"), scalar.epoch(F.col("day").cast("timestamp"))
    return grouped.select(
        device, *identity, F.col("avg").alias("MetricValue"), F.lit("power_metrics").alias("metric_id"), null("string").alias("cpu_inventory"), null("string").alias("memory_inventory"), null("int").alias("pcie_devices_count"),
        (F.col("socket_count").cast("int") if "socket_count" in grouped.columns else null("int")).alias("socket_count"), F.round("avg", 2).alias("avg_metric_value"), F.round("max", 2).alias("max_metric_value"), F.round("min", 2).alias("min_metric_value"),
        date.alias("metric_time"), at.alias("datetime"), (at + RANGE_SECONDS).alias("timeRangeEnd"), null("double").alias("amb_temp"), scalar.epoch(inserted).alias("Insertiontime"), F.lit(CO2_FACTOR).alias("co2_factor"), F.lit(ENERGY_COST_FACTOR).alias("energy_cost_factor"),
        date.alias("max_metric_time"), date.alias("location_date"), date.alias("inventory_date"),
    )


def hot_rows(results: DataFrame, registry: DataFrame, key: str, sensors: dict[str, float]) -> DataFrame:
    """Successful poll results with the registry's hierarchy ids and defaults for missing sensors."""
    ids = registry.select(key, "platform_customer_id", "application_customer_id")
    good = results.where(F.col("status") == "success").join(ids, key, "left")
    return good.withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in sensors.items()}).drop("status")


def messages(readings: DataFrame, registry: DataFrame, n: int, key: str, order: Sequence[Column], time: str, value: str, defaults: dict[str, str]) -> DataFrame:
    """key and value (JSON) of one message for each device: its registry attributes and its latest n readings in time order."""
    latest = first_rows(readings, n, [key], order)
    detail = power_detail(latest, [key], time, value, value, value)
    whole = hydrate(detail, registry, key, defaults)
    return whole.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(key, *defaults, "Average", "Minimum", "Maximum", "PowerDetail")).alias("value"))


def hierarchy_export(readings: DataFrame, registry: DataFrame, key: str, time: str, start: str, end: str, attributes: dict[str, str], **hierarchy: str) -> DataFrame:
    """Readings of [start, end) of the devices of a hierarchy (column=value of the registry), with their attributes or defaults; a hierarchy without devices has none."""
    own = registry
    for c, v in hierarchy.items():
        own = own.where(F.col(c) == F.lit(v))
    own = own.select(key, *hierarchy, *(F.coalesce(F.col(c), F.lit(d)).alias(c) for c, d in attributes.items()))
    rows = readings.where((F.col(time) >= F.lit(start).cast("timestamp")) & (F.col(time) < F.lit(end).cast("timestamp")))
    return rows.join(own, key)


def points(hours: int) -> int:
    """Readings of so many hours."""
    return hours * 12


def unregistered(requests: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """Requests to register a device that none has; of several for one id the first text wins."""
    fresh = requests.join(registry.select(key), key, "left_anti")
    return one_per_key(fresh.withColumn("_o", F.lit(0)), [key], ["_o", *[c for c in fresh.columns if c != key]]).drop("_o")
