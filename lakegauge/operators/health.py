"""Features, preprocessing, anomaly scores and health of device telemetry."""

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip, first_number, ratio
from ..session import ship
from ..sources.sinks import write_text
from .order_stats import quantiles

MANDATORY = ("metric_time", "last_boot_time")


def features(df: DataFrame) -> DataFrame:
    """df with the derived features; rows whose metric_time is no time are dropped. Training and serving share this."""
    if missing := [c for c in MANDATORY if c not in df.columns]:
        raise ValueError(f"columns missing: {missing}")
    df = df.withColumns({c: F.col(c).try_cast("timestamp") for c in (*MANDATORY, "last_maintenance_date") if c in df.columns}).where("metric_time is not null")
    seconds = lambda c: F.unix_timestamp("metric_time") - F.unix_timestamp(c)
    made: dict[str, Column] = {"hour_of_day": F.hour("metric_time"), "day_of_week": F.weekday("metric_time"), "uptime_hours": seconds("last_boot_time") / 3600.0}
    if "last_maintenance_date" in df.columns:
        made["days_since_maintenance"] = F.floor(seconds("last_maintenance_date") / 86400)
    if "memory_capacity_gb" not in df.columns and "memory_inventory" in df.columns:
        made["memory_capacity_gb"] = first_number(F.col("memory_inventory").cast("string"))
    c = F.col
    made |= {
        "temperature_delta": c("cpu_temperature") - c("amb_temp"),
        "power_range": c("max_metric_value") - c("min_metric_value"),
        "fan_temp_ratio": ratio(c("fan_speed_rpm"), c("cpu_temperature") + 1),
        "power_per_socket": ratio(c("avg_metric_value"), c("socket_count")) if "socket_count" in df.columns else c("avg_metric_value"),
        "cpu_memory_ratio": ratio(c("cpu_utilization"), c("memory_utilization") + 1),
        "cpu_disk_ratio": ratio(c("cpu_utilization"), c("disk_utilization") + 1),
    }
    return df.withColumns(made)


@dataclass
class Preprocessor:
    """Medians, means and population deviations of numbers; modes and codes of categories. A column of more than most categories is no category and raises."""

    numbers: dict[str, tuple[float, float, float]]
    categories: dict[str, tuple[str | None, dict[str, int]]]

    @classmethod
    def fit(cls, df: DataFrame, numbers: Sequence[str], categories: Sequence[str], most: int = 10_000) -> "Preprocessor":
        medians = {c: m for c, (m,) in quantiles(df, {c: F.col(c) for c in numbers}, (0.5,)).items()} if numbers else {}
        filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in numbers}
        spread = df.agg(*(f(filled[c]).alias(f"{c}_{n}") for c in numbers for n, f in (("m", F.avg), ("s", F.stddev_pop)))).collect()[0] if numbers else {}
        kinds = {}
        for c in categories:
            counts = df.where(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).limit(most + 1).collect()
            if len(counts) > most:
                raise ValueError(f"{c} has more than {most} categories")
            kinds[c] = (counts[0][0] if counts else None, {v: i for i, v in enumerate(sorted(r[0] for r in counts))})
        return cls({c: (medians[c], spread[f"{c}_m"], spread[f"{c}_s"] or 1.0) for c in numbers}, kinds)

    def transform(self, df: DataFrame) -> DataFrame:
        """df with x_ columns; categories unknown to the fit are -1."""
        out = {f"x_{c}": (F.coalesce(F.col(c).cast("double"), F.lit(m)) - F.lit(mean)) / F.lit(sd) for c, (m, mean, sd) in self.numbers.items()}
        for c, (mode, codes) in self.categories.items():
            code = F.try_element_at(F.create_map(*(F.lit(x) for kv in codes.items() for x in kv)), F.coalesce(F.col(c), F.lit(mode))) if codes else F.lit(None)
            out[f"x_{c}"] = F.coalesce(code, F.lit(-1)).cast("double")
        return df.withColumns(out)


def _average_path(n):
    """Mean depth of an unsuccessful search in a binary tree of n keys."""
    n = np.asarray(n, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 2, 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


def grow(x: np.ndarray, rng: np.random.Generator, deepest: int) -> list[tuple[int, float, int, int, float]]:
    """A tree's nodes: feature (-1: leaf), cut, children and a leaf's path length. Cuts are uniform over a feature that varies."""
    tree: list[tuple[int, float, int, int, float]] = []

    def node(own: np.ndarray, depth: int) -> int:
        at = len(tree)
        tree.append((-1, 0.0, at, at, depth + float(_average_path(len(own)))))
        spread = np.flatnonzero(own.max(axis=0) > own.min(axis=0)) if len(own) > 1 else []
        if depth < deepest and len(spread):
            f = int(rng.choice(spread))
            cut = rng.uniform(own[:, f].min(), own[:, f].max())
            left = own[:, f] < cut
            tree[at] = (f, cut, node(own[left], depth + 1), node(own[~left], depth + 1), 0.0)
        return at

    node(x, 0)
    return tree


class IsolationForest:
    """Isolation trees (Liu, Ting, Zhou 2008), each grown in a task from a sample of its own of all rows; scoring is distributed.

    Every row has as many tickets as the trees need, and a ticket names one tree. What decides is a hash of
    the row's key (all its features by default: equal rows are one then), so any partitioning grows the same trees.
    """

    #: Tickets for each row that a tree takes.
    SPARE = 1.5
    #: Rows that walk through all trees together.
    ROWS = 256

    def __init__(self, trees: int = 500, sample: int = 512, seed: int = 42):
        self.trees, self.sample, self.seed, self.columns, self.nodes, self.norm = trees, sample, seed, [], [], 1.0

    def fit(self, df: DataFrame, columns: Sequence[str], key: Sequence[str] = ()) -> "IsolationForest":
        """Rows with a null feature take no part. Only the trees come to the driver, some 2 * sample nodes each."""
        self.columns = list(columns)
        names = [f"f{i}" for i in range(len(columns))]
        rows = df.select(*(F.col(c).cast("double").alias(n) for c, n in zip(columns, names)), *(F.col(c).alias(f"k{i}") for i, c in enumerate(key))).dropna(subset=names)
        own = [f"k{i}" for i in range(len(key))] or names
        rows = rows if key else rows.dropDuplicates(names)
        total = rows.count()
        wanted = self.SPARE * self.trees * self.sample
        tickets = max(1, math.ceil(wanted / max(1, total)))
        share = min(1.0, wanted / max(1, total * tickets))
        ticket = F.explode(F.sequence(F.lit(0), F.lit(tickets - 1)))
        drawn = rows.select("*", ticket.alias("ticket")).withColumn("h", F.xxhash64(F.lit(self.seed), "ticket", *own))
        drawn = drawn.where(F.shiftrightunsigned("h", 34) < math.ceil(share * (1 << 30))).withColumn("tree", F.pmod(F.xxhash64("h", F.lit(1)), F.lit(self.trees)).cast("int"))
        size, seed, deepest = self.sample, self.seed, math.ceil(math.log2(max(2, self.sample)))
        ship(df.sparkSession)

        def one(group: pd.DataFrame) -> pd.DataFrame:
            chosen = group.sort_values(["h", *names]).head(size)
            tree = int(group["tree"].iloc[0])
            nodes = grow(chosen[names].to_numpy(float), np.random.default_rng([seed, tree]), deepest)
            return pd.DataFrame([(tree, len(chosen), *map(list, zip(*nodes)))], columns=["tree", "n", "feature", "cut", "left", "right", "depth"])

        made = drawn.groupBy("tree").applyInPandas(one, "tree int, n int, feature array<int>, cut array<double>, left array<int>, right array<int>, depth array<double>")
        grown = made.orderBy("tree").collect()
        self.nodes = [tuple(np.array(r[c], k) for c, k in (("feature", int), ("cut", float), ("left", int), ("right", int), ("depth", float))) for r in grown]
        self.norm = float(_average_path(min(self.sample, max(2, max((r["n"] for r in grown), default=2)))))
        return self

    def _flat(self) -> tuple[np.ndarray, ...]:
        """All trees as one: roots, features, cuts, the two children side by side (a leaf's are itself), depths and levels."""
        size = np.array([len(t[0]) for t in self.nodes])
        first = np.cumsum(size) - size
        shift = np.repeat(first, size)
        feature, cut, left, right, depth = (np.concatenate(x) for x in zip(*self.nodes))
        children = np.stack([left + shift, right + shift], axis=1).ravel()
        levels, at = 0, first
        while (feature[at] >= 0).any():  # the deepest tree
            at = np.unique(children.reshape(-1, 2)[at][feature[at] >= 0])
            levels += 1
        return first, np.maximum(feature, 0), np.where(feature < 0, -np.inf, cut), children, depth, levels

    def depths(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of each row; rows walk through all trees at once, a level a step."""
        if not self.nodes:
            return np.zeros(len(x))
        roots, feature, cut, children, depth, levels = self._flat()
        out = np.empty(len(x))
        for lo in range(0, len(x), self.ROWS):
            rows = x[lo : lo + self.ROWS]
            index = np.arange(len(rows))[:, None]
            at = np.repeat(roots[None], len(rows), axis=0)
            for _ in range(levels):
                at = children[2 * at + (rows[index, feature[at]] >= cut[at])]
            out[lo : lo + len(rows)] = depth[at].mean(axis=1)
        return out

    def score(self, df: DataFrame, to: str = "anomaly_score") -> DataFrame:
        """df with 0.5 - 2^(-depth / mean depth): below 0 is unlike the sample; null features give null."""
        own = self
        ship(df.sparkSession)

        @F.pandas_udf("double")
        def scored(x: pd.DataFrame) -> pd.Series:
            values = x.to_numpy(float)
            out = 0.5 - 2.0 ** (-own.depths(np.nan_to_num(values)) / own.norm)
            return pd.Series(np.where(np.isnan(values).any(axis=1), np.nan, out)).astype(object).where(~np.isnan(values).any(axis=1), None)

        return df.withColumn(to, scored(F.struct(*(F.col(c).cast("double").alias(c) for c in self.columns))))


@dataclass
class Artifacts:
    """What serving needs: preprocessor, forest, and the training scores' threshold, least and most."""

    preprocessor: Preprocessor
    forest: IsolationForest
    limits: dict[str, float]

    def save(self, spark, path: str) -> None:
        """As one JSON file on shared storage."""
        forest = {k: getattr(self.forest, k) for k in ("trees", "sample", "seed", "columns", "norm")}
        forest["nodes"] = [[x.tolist() for x in tree] for tree in self.forest.nodes]
        write_text(spark, path, json.dumps({"numbers": self.preprocessor.numbers, "categories": self.preprocessor.categories, "forest": forest, "limits": self.limits}))

    @classmethod
    def load(cls, spark, path: str) -> "Artifacts":
        """Raises if the file is missing or lacks a part."""
        state = json.loads(spark.read.option("wholetext", "true").text(path).collect()[0][0])
        if missing := {"numbers", "categories", "forest", "limits"} - set(state):
            raise ValueError(f"artifacts lack {sorted(missing)}")
        own = state["forest"]
        forest = IsolationForest(own["trees"], own["sample"], own["seed"])
        forest.columns, forest.norm, forest.nodes = own["columns"], own["norm"], [tuple(map(np.array, tree)) for tree in own["nodes"]]
        return cls(Preprocessor({k: tuple(v) for k, v in state["numbers"].items()}, {k: (m, codes) for k, (m, codes) in state["categories"].items()}), forest, state["limits"])


def classified(df: DataFrame, stored: dict[str, float] | None, score: str = "anomaly_score", share: float = 0.2) -> DataFrame:
    """df with prediction by the stored threshold, or by the batch's own percentile if none is stored."""
    limit = (stored or {}).get("threshold")
    if limit is None:
        limit = threshold(df, score, share)["threshold"]
    return df.withColumn("prediction", prediction(F.col(score), F.lit(limit)))


def threshold(df: DataFrame, score: str = "anomaly_score", share: float = 0.2) -> dict[str, float]:
    """The score's exact percentile, minimum and maximum."""
    limits = df.agg(F.min(score).alias("min_score"), F.max(score).alias("max_score")).collect()[0].asDict()
    return {"threshold": quantiles(df, {"score": F.col(score)}, (share,))["score"][0]} | limits


def prediction(score: Column, limit: Column) -> Column:
    return F.when(score < limit, -1).otherwise(1)


def status(score: Column) -> Column:
    return F.when(score >= 90, "Healthy").when(score >= 70, "Warning").when(score >= 50, "Degraded").otherwise("Critical")


def training_status(score: Column) -> Column:
    return F.when(score >= 90, "Healthy").when(score >= 50, "Warning").otherwise("Degraded")


def anomaly_component(score: Column, low: Column, high: Column) -> Column:
    return F.when(high == low, F.lit(50.0)).otherwise(clip(F.try_divide((score - low) * 100.0, high - low), 0.0, 100.0))


def health(df: DataFrame, value: str = "avg_metric_value", score: str = "anomaly_score", low: float | None = None, high: float | None = None, history: DataFrame | None = None, device: str = "device_id", hour: str = "hour_of_day", weights=(0.5, 0.3, 0.2)) -> DataFrame:
    """df with ahc, dhc, tcc, health_score and health_status.

    The batch's figures come from one aggregate whose single row is broadcast; history (the batch
    itself by default) is averaged by device and hour before it is joined.
    """
    figures = df.agg(F.min(value).alias("_min"), F.max(value).alias("_max"), F.avg(value).alias("_avg"), F.min(score).alias("_low"), F.max(score).alias("_high"))
    expected = (df if history is None else history).groupBy(device, hour).agg(F.avg(value).alias("_expected"))
    rows = df.join(expected, [device, hour], "left").crossJoin(F.broadcast(figures))
    span = F.col("_max") - F.col("_min")
    away = lambda centre: F.when(span == 0, F.lit(100.0)).otherwise(clip((F.lit(1.0) - F.try_divide(F.abs(F.col(value) - centre), span)) * 100.0, 0.0, 100.0))
    a = anomaly_component(F.col(score), F.lit(low) if low is not None else F.col("_low"), F.lit(high) if high is not None else F.col("_high"))
    d = away(F.col("_avg"))
    rows = rows.withColumns({"ahc": a, "dhc": d, "tcc": F.coalesce(away(F.col("_expected")), d)})
    total = clip(weights[0] * F.col("ahc") + weights[1] * F.col("dhc") + weights[2] * F.col("tcc"), 0.0, 100.0)
    return rows.withColumn("health_score", total).withColumn("health_status", status(F.col("health_score"))).drop("_min", "_max", "_avg", "_low", "_high", "_expected")
