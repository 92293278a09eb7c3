"""Series along ordered groups: recursions by a scan of affine maps over range partitions, and ramps."""

import math
from collections.abc import Iterator
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, ship


class Map:
    """x -> rho^n * x + b for n steps; for |rho| > 1 as rho^n * (x + b), so that b stays finite however long it is."""

    def __init__(self, rho: float, n: int = 0, b: float = 0.0):
        self.rho, self.n, self.b = rho, n, b

    def then(self, noise: list[float]) -> "Map":
        """The map of these steps and then of the noise's."""
        rho = self.rho
        if abs(rho) <= 1:
            b = self.b
            for e in noise:
                b = b * rho + e
            return Map(rho, self.n + len(noise), b)
        b, weight = self.b, _power(1 / rho, self.n)
        for e in noise:
            weight /= rho
            b += e * weight
            if not weight and not self.n:
                break
        return Map(rho, self.n + len(noise), b)

    def after(self, other: "Map") -> "Map":
        """First other, then this one."""
        if abs(self.rho) <= 1:
            return Map(self.rho, self.n + other.n, _power(self.rho, self.n) * other.b + self.b)
        return Map(self.rho, self.n + other.n, other.b + _power(1 / self.rho, other.n) * self.b)

    def value(self) -> float:
        """Of 0; infinite where a double overflows."""
        return self.b if abs(self.rho) <= 1 else _scaled(self.b, self.rho, self.n)


def _power(x: float, n: int) -> float:
    try:
        return x**n
    except OverflowError:
        return math.inf if x > 0 or n % 2 == 0 else -math.inf


def _scaled(b: float, rho: float, n: int) -> float:
    """b * rho^n, of which neither factor need be a double of its own."""
    for part in (n // 2, n - n // 2):
        b = b * _power(rho, part) if b else b
    return b


def autoregressive(df: DataFrame, by: str, order: str, noise: str, rho: float = 0.7, to: str = "x") -> DataFrame:
    """x_t = rho * x_(t-1) + e_t along each group, for any rho, without a window or a group in one task.

    Rows are dealt over range partitions by (group, order). A step of the recursion is an affine map, so a
    pass over the partitions composes what each does to its last group, a row or two for each partition; a scan of
    these on the driver gives the value that enters each partition, and a second pass runs each from there.
    A null e counts as 0; rows of one group and order come by e; a null group is a group; x that
    overflows is infinite, as it is in a plain loop.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(by).alias("g"), F.col(order).alias("o"), F.coalesce(F.col(noise).cast("double"), F.lit(0.0)).alias("e"))
    # both passes need the same partitions
    rows = checkpointed(rows.repartitionByRange("g", "o").sortWithinPartitions("g", "o", "e"))

    def groups(batches) -> Iterator[tuple[object, list, list[float]]]:
        """Pieces of groups, in order."""
        for batch in batches:
            key = batch.column(0).to_pylist()
            at, e = 0, batch.column(2).to_pylist()
            for g, run in groupby(key):
                n = sum(1 for _ in run)
                yield g, batch.slice(at, n), e[at : at + n]
                at += n

    def ends(batches):
        """The maps of the partition's first and last groups."""
        from pyspark import TaskContext

        first = last = None
        number = TaskContext.get().partitionId()
        for g, part, e in groups(batches):
            if first is None:
                first = last = [g, Map(rho), part.column(0).slice(0, 1)]
            elif g != last[0]:
                last = [g, Map(rho), part.column(0).slice(0, 1)]
            last[1] = last[1].then(e)
        for i, end in enumerate([first, last] if first is not last else [first] if first else []):
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([i], pa.int32()), end[2], pa.array([end[1].n]), pa.array([end[1].b])], ["block", "end", "g", "n", "b"])

    kind = rows.schema["g"].dataType.simpleString()
    found = rows.mapInArrow(ends, f"block int, end int, g {kind}, n long, b double").orderBy("block", "end").collect()
    enters, group, state = {}, object(), Map(rho)  # what enters each block, for its first group
    for r in found:
        if r["end"] == 0:
            state = state if r["g"] == group else Map(rho)
            enters[r["block"]] = state.value()
        else:
            state = Map(rho)
        group, state = r["g"], Map(rho, r["n"], r["b"]).after(state)

    def run(batches):
        from pyspark import TaskContext

        x, before, first = enters.get(TaskContext.get().partitionId(), 0.0), None, True
        for g, part, e in groups(batches):
            if not first and g != before:
                x = 0.0
            first, before = False, g
            out = list(accumulate(e, lambda x, e: x * rho + e, initial=x))[1:]
            x = out[-1]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out)], ["g", "o", "x"])

    made = rows.mapInArrow(run, f"g {kind}, o {rows.schema['o'].dataType.simpleString()}, x double")
    return made.select(F.col("g").alias(by), F.col("o").alias(order), F.col("x").alias(to))


def ramp(df: DataFrame, by: str, order: str, low: float, high: float, to: str = "ramp") -> DataFrame:
    """A straight line from low to high over each group's rows."""
    w, whole = Window.partitionBy(by).orderBy(order), Window.partitionBy(by)
    at = F.try_divide((F.row_number().over(w) - 1).cast("double"), F.count("*").over(whole) - 1)
    return df.withColumn(to, F.lit(low) + (high - low) * F.coalesce(at, F.lit(0.0)))
