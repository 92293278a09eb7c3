"""Queries by name, each with the SQL of its result where SQL has one."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, folder) under its name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tables.read(spark, folder, name)


def stamp(c: str | Column) -> Column:
    """A time as text, as strftime writes it."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


#: strftime's pattern for stamp.
S = "'%Y-%m-%d %H:%M:%S'"
