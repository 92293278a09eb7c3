"""Column expressions that the operators share. NULL in, NULL out unless said."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_number(text: Column) -> Column:
    """The first run of digits as a double; null if there is none."""
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("double")


def iso(time: Column) -> Column:
    """ISO text with Z, of a UTC time."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_time(text: Column) -> Column:
    """A time from ISO text, or from day/month/year text if it holds a slash; null if it is neither."""
    return F.when(text.contains("/"), F.try_to_timestamp(text, F.lit("dd/MM/yyyy HH:mm:ss"))).otherwise(F.try_to_timestamp(text))


def epoch(time: Column) -> Column:
    return F.unix_timestamp(time).cast("double")


def floor_time(seconds: Column, step: int) -> Column:
    """Epoch seconds rounded down to a step."""
    return seconds - F.pmod(seconds, F.lit(step))


def clip(x: Column, low: float, high: float) -> Column:
    """x between low and high; null stays null."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is 0."""
    return F.try_divide(a.cast("double"), b)


def shorten(text: Column, n: int = 30) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def id_list(text: Column) -> Column:
    """Trimmed, non-empty ids of comma-separated text."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def key_hash(*columns: str) -> Column:
    """SHA-256 of the columns' text. A null counts as text of its own, so (a, null, b) differs from (a, b)."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns)), 256)


def uniform(seed: int, *columns) -> Column:
    """A number in [0, 1) that depends on the columns and the seed alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30)) / F.lit(float(1 << 30))
