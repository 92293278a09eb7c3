"""Scans: typed and inferred Parquet, ranges, newest files, hour caches, registries and sensor text."""

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a folder; times become TIMESTAMP, so every later function has one type for them."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*(F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.simpleString() == "timestamp_ntz" else F.col(f.name) for f in df.schema))


def typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet with a declared schema: absent columns are null, others are not read."""
    return spark.read.schema(schema).parquet(path)


def time_range(df: DataFrame, time: str, start: str, end: str, closed: str = "left") -> DataFrame:
    """Rows of [start, end), or of (start, end] with closed='right'. Literals, so the scan can prune."""
    t, a, b = F.col(time), F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    return df.where((t >= a) & (t < b) if closed == "left" else (t > a) & (t <= b))


def parquet_files(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(time written, name) of the Parquet files under path, from the file listing alone; logs and hidden files left out."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found, out = fs.listFiles(root, True) if fs.exists(root) else None, []
    while found is not None and found.hasNext():
        status = found.next()
        name = status.getPath().toString()
        inner = name.split(root.toUri().getPath(), 1)[-1].split("/")
        if name.endswith(".parquet") and not any(x.startswith(("_", ".")) for x in inner):
            out.append((status.getModificationTime(), name))
    return sorted(out)


def ready(spark: SparkSession, path: str) -> bool:
    """Whether any Parquet file has arrived under path."""
    return bool(parquet_files(spark, path))


def newest_file(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows of the file written last under path (ties: the greater name). Other files are listed, not read."""
    files = parquet_files(spark, path)
    if not files:
        raise FileNotFoundError(f"no Parquet file under {path}")
    return (spark.read.schema(schema) if schema else spark.read).parquet(files[-1][1])


def with_column_only(spark: SparkSession, path: str, column: str, at_a_time: int = 16) -> DataFrame:
    """All files under path merged, without those whose schema lacks a column; footers alone are read, many at a time and without a job each."""
    names = [name for _, name in parquet_files(spark, path)]
    hadoop = spark._jsc.hadoopConfiguration()
    footers = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader

    def has(name: str) -> bool:
        target = spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(spark._jvm.org.apache.hadoop.fs.Path(name), hadoop)
        reader = footers.open(target)
        try:
            return reader.getFooter().getFileMetaData().getSchema().containsField(column)
        finally:
            reader.close()

    with ThreadPoolExecutor(at_a_time) as pool:
        holding = [name for name, there in zip(names, pool.map(has, names)) if there]
    if not holding:
        raise FileNotFoundError(f"no file under {path} has {column}")
    return spark.read.option("mergeSchema", "true").parquet(*holding)


def cursor(df: DataFrame, *order: str, rows: int = 10_000) -> Iterator[list]:
    """Rows in order, so many at a time: a range shuffle sorts them, and the driver holds one partition's at most, asked for as they are read."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    held = []
    for row in parts.toLocalIterator():
        held.append(row)
        if len(held) == rows:
            yield held
            held = []
    if held:
        yield held


def first_readable(spark: SparkSession, *paths: str) -> DataFrame:
    """The first of several places that reads as Parquet."""
    error: Exception | None = None
    for path in paths:
        try:
            return spark.read.parquet(path)
        except Exception as e:  # the next place may have it
            error = e
    raise FileNotFoundError(f"none of {paths} can be read") from error


def hour_cache(spark: SparkSession, path: str, start: str, end: str, platform: str, application: str) -> DataFrame:
    """Rows of the cache's hours in [start, end) for one hierarchy: partitions prune by date, hour and ids."""
    df = spark.read.parquet(path)
    a, b = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    hour = F.to_timestamp(F.concat_ws(" ", F.col("date").cast("string"), F.format_string("%02d:00:00", F.col("hour").cast("int"))))
    days = F.col("date").cast("date").between(F.to_date(a), F.to_date(b))
    return df.where(days & (hour >= F.date_trunc("hour", a)) & (hour < b) & (F.col("pcid") == platform) & (F.col("acid") == application))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of devices as rows (device_id, attributes...)."""
    whole = spark.read.option("wholetext", "true").text(path)
    entries = whole.select(F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("device_id", "a"))
    fields = ("platform_customer_id", "application_customer_id", "location_id", "location_name", "model", "server_name")
    return entries.select("device_id", *(F.try_element_at("a", F.lit(f)).alias(f) for f in fields))


def hierarchy_index(devices: DataFrame, *keys: str, device: str = "device_id") -> DataFrame:
    """Devices of each hierarchy, in order."""
    return devices.groupBy(*keys).agg(F.array_sort(F.collect_list(device)).alias("devices"), F.count("*").alias("n_devices"))


def sensor_number(text: str | Column) -> Column:
    """The number in 'name | 210 Watts | ok' or 'name : 210 Watts'; null if there is none."""
    field = F.trim(F.element_at(F.split(text, r"[:|]"), 2))
    return F.regexp_extract(field, r"^(-?[0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")


def query_frame(spark: SparkSession, sql: str) -> DataFrame:
    """The result of any query, with columns that are no number, time or truth value as text (JSON if nested)."""
    df = spark.sql(sql)
    plain = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz"}
    nested = lambda kind: kind.startswith(("array", "struct", "map"))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.select(*(F.col(f"`{c}`") if k in plain or k.startswith("decimal") else (F.to_json(f"`{c}`") if nested(k) else F.col(f"`{c}`").cast("string")).alias(c) for c, k in kinds.items()))


def shown_in(time: str | Column, zone: str = "Asia/Kolkata") -> Column:
    """A UTC time as the clock of a zone shows it."""
    return F.from_utc_timestamp(time, zone)


def metrics_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a declared schema."""
    return spark.read.schema(schema).json(path)


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """Column names with their class: time, number or text."""
    kinds = {"timestamp": "time", "date": "time", "timestamp_ntz": "time", "bigint": "number", "int": "number", "double": "number", "float": "number", "smallint": "number"}
    return [(n, kinds.get(t, "text")) for n, t in df.dtypes]


def kafka(spark: SparkSession, servers: str, *topics: str, per_trigger: int = 3000, partitions: int = 12) -> DataFrame:
    """A stream of records from topics; needs the connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": "latest", "maxOffsetsPerTrigger": str(per_trigger), "minPartitions": str(partitions), "failOnDataLoss": "false"}
    return spark.readStream.format("kafka").options(**options).load()


def inventory(text):
    """Hardware of 'key: value' lines as (model, cores, memory); null where a line is missing."""
    find = lambda key: F.nullif(F.trim(F.regexp_extract(text, rf"(?m)^\s*{key}\s*:\s*(.*)$", 1)), F.lit(""))
    return F.struct(find("Model").alias("model"), F.regexp_extract(find("Cores"), r"(\d+)", 1).try_cast("int").alias("cores"), F.regexp_extract(find("Memory"), r"(\d+)", 1).try_cast("int").alias("memory_gb"))
