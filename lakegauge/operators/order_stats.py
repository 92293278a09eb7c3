"""Exact order statistics of columns, with bounded memory in every task and on the driver.

A wanted rank lies in an interval of values, at first all of them. While an interval has more than
FETCH rows, a sample of about SAMPLE of its values cuts it: a pass counts the rows at each cut and
between cuts, one small array a task, and the rank goes on in the one part that holds it. A cut that many
rows have is a part by itself, so ties never need to be taken apart. What is left of at most FETCH
rows is fetched as counts of values. The sample decides how many passes there are, not the result.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship

SAMPLE, FETCH = 2048, 20_000


@dataclass
class Interval:
    """The rows of a column with low < value < high (None: no end); before: how many rows lie below them."""

    column: int
    before: int
    size: int
    ranks: list[int]
    low: float | None = None
    high: float | None = None
    cuts: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def holds(self) -> Column:
        """NaN is greater than any number, as Spark sorts it."""
        value = F.col(f"c{self.column}")
        inside = value.isNotNull()
        if self.low is not None:
            inside &= value > F.lit(self.low)
        return inside if self.high is None else inside & (value < F.lit(self.high))

    def parts(self, counts: np.ndarray, found: dict[int, float]) -> list["Interval"]:
        """The parts that hold wanted ranks; counts: between cuts (even) and at cuts (odd)."""
        after, out = self.before + np.cumsum(counts), {}
        for rank in self.ranks:
            part = int(np.searchsorted(after, rank, "right"))
            if part % 2:
                found[rank] = float(self.cuts[part // 2])
                continue
            low = self.low if part == 0 else float(self.cuts[part // 2 - 1])
            high = self.high if part == len(counts) - 1 else float(self.cuts[part // 2])
            out.setdefault(part, Interval(self.column, int(after[part] - counts[part]), int(counts[part]), [], low, high)).ranks.append(rank)
        return list(out.values())


def _sampled(rows: DataFrame, open_: list[Interval], sample: int, turn: int) -> None:
    """Cuts for each interval, from about so many of its values."""
    draw = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(turn)), F.lit(1 << 30))
    picked = [F.when(x.holds() & (draw < math.ceil(min(1.0, sample / x.size) * (1 << 30))), F.struct(F.lit(i).alias("i"), F.col(f"c{x.column}").alias("v"))) for i, x in enumerate(open_)]
    found = rows.select(F.explode(F.array_compact(F.array(*picked))).alias("s")).select("s.*").distinct().collect()  # sample values of an interval
    for i, x in enumerate(open_):
        x.cuts = np.unique(np.array([r["v"] for r in found if r["i"] == i], np.float64))


def _counted(rows: DataFrame, open_: list[Interval]) -> dict[int, np.ndarray]:
    """How many rows each interval has at and between its cuts."""
    ship(rows.sparkSession)
    spans = [(x.column, x.low, x.high, x.cuts) for x in open_]

    def run(batches):
        total = [np.zeros(2 * len(cuts) + 1, np.int64) for *_, cuts in spans]
        for batch in batches:
            for t, (column, low, high, cuts) in zip(total, spans):
                v = batch.column(column).drop_null().to_numpy()
                least = np.searchsorted(cuts, v, "left")
                part = least + np.searchsorted(cuts, v, "right")
                # of one interval among several of a column
                keep = np.ones(len(v), bool)
                if low is not None:
                    keep &= (v > low) | np.isnan(v)
                if high is not None:
                    keep &= ~np.isnan(v) if math.isnan(high) else v < high
                t += np.bincount(part[keep], minlength=len(t))
        for i, t in enumerate(total):
            there = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(there), i, np.int32)), pa.array(there.astype(np.int32)), pa.array(t[there])], ["i", "part", "n"])

    out = {i: np.zeros(2 * len(x.cuts) + 1, np.int64) for i, x in enumerate(open_)}
    for r in rows.mapInArrow(run, "i int, part int, n long").groupBy("i", "part").agg(F.sum("n").alias("n")).collect():  # two rows for each cut
        out[r["i"]][r["part"]] = r["n"]
    return out


def _fetched(rows: DataFrame, small: list[Interval], found: list[dict[int, float]]) -> None:
    """The wanted values of intervals of few rows."""
    each = [F.when(x.holds(), F.struct(F.lit(i).alias("i"), F.col(f"c{x.column}").alias("v"))) for i, x in enumerate(small)]
    counts: dict[int, list] = {}
    for r in rows.select(F.explode(F.array_compact(F.array(*each))).alias("s")).select("s.*").groupBy("i", "v").agg(F.count("*").alias("n")).collect():  # FETCH rows of an interval at most
        counts.setdefault(r["i"], []).append((math.isnan(r["v"]), r["v"], r["n"]))
    for i, x in enumerate(small):
        own = sorted(counts[i], key=lambda e: (e[0], 0.0 if e[0] else e[1]))
        after = x.before + np.cumsum([n for *_, n in own])
        for rank in x.ranks:
            found[x.column][rank] = own[int(np.searchsorted(after, rank, "right"))][1]


def quantiles(df: DataFrame, columns: dict[str, Column], shares: Sequence[float], sample: int = SAMPLE, fetch: int = FETCH) -> dict[str, list[float | None]]:
    """Of each column, its quantiles at the shares, interpolated between neighbours; nulls do not count, and without values all are None."""
    names = list(columns)
    rows = df.select(*(c.cast("double").alias(f"c{i}") for i, c in enumerate(columns.values())))
    sizes = rows.agg(*(F.count(f"c{i}") for i in range(len(names)))).collect()[0]
    places = [[s * (n - 1) for s in shares] if n else [] for n in sizes]
    open_ = [Interval(i, 0, n, sorted({f(p) for p in places[i] for f in (math.floor, math.ceil)})) for i, n in enumerate(sizes) if n]
    found: list[dict[int, float]] = [{} for _ in names]
    turn = 0
    while open_:
        small, large = [x for x in open_ if x.size <= fetch], [x for x in open_ if x.size > fetch]
        if small:
            _fetched(rows, small, found)
        open_ = []
        if large:
            _sampled(rows, large, sample, turn)
            for i, counts in _counted(rows, large).items():
                open_ += large[i].parts(counts, found[large[i].column])
        turn += 1
    out = {}
    for name, own, at in zip(names, found, places):
        between = [(own[math.floor(p)], own[math.ceil(p)], p - math.floor(p)) for p in at]
        out[name] = [a if f == 0 or a == b else a + (b - a) * f for a, b, f in between] or [None] * len(shares)
    return out
