"""JSON records as VARIANT values: one parse, fields by path, one rule of classification for batches and streams, and drift of their shape."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The fields that a record must have, by path.
DEVICE, DETAIL, SOCKETS = "$.device_id", "$.data.PowerDetail", "$.inventory_data.socket_count"


def record(text: Column) -> Column:
    """The text's JSON value; null for null, blank and broken text."""
    return F.try_parse_json(F.nullif(F.trim(text), F.lit("")))


def whole_number(value: Column, path: str) -> Column:
    """The integer at a path; null for any other type, numeric text and fractions too, and beyond 32 bits."""
    at = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(at) == "BIGINT", F.try_variant_get(value, path, "int"))


def error_type(text: Column, value: Column, device: str = DEVICE, detail: str = DETAIL, sockets: str = SOCKETS) -> Column:
    """The first fault of a record, or VALID.

    Null or blank text is INVALID_SCHEMA. Broken text and JSON that is no object have no device, which
    is what they lack first. Faults inside the detail's entries are none of the record's.
    """
    return (
        F.when(F.coalesce(F.trim(text), F.lit("")) == "", "INVALID_SCHEMA")
        .when(F.try_variant_get(value, device, "string").isNull(), "MISSING_DEVICE_ID")
        .when(F.try_variant_get(value, detail, "array<variant>").isNull(), "MISSING_POWERDETAIL")
        .when(whole_number(value, sockets).isNull(), "INVALID_SOCKET_COUNT")
        .otherwise("VALID")
    )


def classified(df: DataFrame, schema: str | None = None, value: str = "value") -> DataFrame:
    """df with raw (the text), record (its VARIANT), error_type and, with a schema, parsed: the typed fields of valid records."""
    rows = df.withColumn("raw", F.col(value).cast("string"))
    rows = rows.withColumn("record", record(F.col("raw")))
    rows = rows.withColumn("error_type", error_type(F.col("raw"), F.col("record")))
    return rows if schema is None else rows.withColumn("parsed", F.when(F.col("error_type") == "VALID", F.from_json("raw", schema)))


def readings(df: DataFrame, *keep: str, detail: str = DETAIL) -> DataFrame:
    """A row for each entry of the detail: keep, position and Average (null where it is no number); the rest of the record stays as it came."""
    entries = df.select(*keep, F.posexplode(F.try_variant_get("record", detail, "array<variant>")).alias("position", "entry"))
    kind = F.schema_of_variant(F.try_variant_get("entry", "$.Average", "variant"))
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return entries.select(*keep, "position", F.when(number, F.try_variant_get("entry", "$.Average", "double")).alias("Average"))


def drift(df: DataFrame, *by: str) -> DataFrame:
    """The merged shape of all records of each group, and how many there are: a field of a new name or type shows in it."""
    return df.where(F.col("record").isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.schema_of_variant_agg("record").alias("shape"))
