import math
import random

import numpy as np
import pytest
from lakegauge.operators import health, order_stats, quality
from pyspark.sql import functions as F


def plain(values, share):
    own = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), 0.0 if math.isnan(v) else v))
    if not own:
        return None
    at = share * (len(own) - 1)
    a, b = own[math.floor(at)], own[math.ceil(at)]
    return a if a == b or at == math.floor(at) else a + (b - a) * (at - math.floor(at))


SHARES = (0.0, 0.2, 0.5, 0.95, 0.99, 1.0)
RNG = random.Random(7)
CASES = {
    "spread": [RNG.gauss(0, 100) for _ in range(5000)],
    "ties": [float(RNG.randint(0, 5)) for _ in range(3000)] + [None] * 50,
    "one value": [4.25] * 2500,
    "hot value": [1.0] * 3000 + [RNG.random() for _ in range(1000)],
    "tails": [RNG.choice([-1, 1]) * math.exp(RNG.gauss(0, 30)) for _ in range(3000)] + [math.inf, -math.inf, 0.0, -0.0],
    "not numbers": [float(i) for i in range(1500)] + [math.nan] * 700,
    "few": [3.0, None, 1.0],
    "single": [2.0],
    "none": [None, None],
    "empty": [],
}


def same(a, b):
    return a == b or (a is not None and b is not None and (math.isnan(a) and math.isnan(b) or a == pytest.approx(b, rel=1e-12)))


@pytest.mark.parametrize("name", CASES)
def test_quantiles_against_a_plain_sort(spark, name):
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    for limits in ({}, {"sample": 20, "fetch": 30}, {"sample": 3, "fetch": 1}):
        found = order_stats.quantiles(df, {"v": F.col("v")}, SHARES, **limits)["v"]
        want = [plain(values, s) for s in SHARES]
        assert all(same(a, b) for a, b in zip(found, want)), (limits, found, want)


def test_several_columns_at_once(spark):
    rows = [(float(i), float(i % 7), None if i % 3 else -float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    found = order_stats.quantiles(df, {n: F.col(n) for n in "abc"}, SHARES, sample=16, fetch=50)
    for k, n in enumerate("abc"):
        assert all(same(x, plain([r[k] for r in rows], s)) for x, s in zip(found[n], SHARES)), n


def test_many_distinct_values_with_little_fetched(spark):
    df = spark.range(3_000_000).select((F.col("id") * 7919 % 3_000_017).cast("double").alias("v"))
    want = np.quantile(np.arange(3_000_000, dtype=np.int64) * 7919 % 3_000_017, SHARES)
    assert order_stats.quantiles(df, {"v": F.col("v")}, SHARES)["v"] == pytest.approx(list(want), rel=1e-12)


def test_no_plan_gathers_all_values(spark):
    df = spark.createDataFrame([(float(i % 90), "ab"[i % 2]) for i in range(500)], "v double, c string")
    for made in (quality.latencies(df, ["v"]), quality.outliers(df, "v"), quality.breakdown(df, {"x": F.col("v")}, F.col("v")), health.classified(df, None, "v")):
        assert "percentile" not in made._jdf.queryExecution().optimizedPlan().toString().lower()
    assert health.Preprocessor.fit(df, ["v"], ["c"]).numbers["v"][0] == plain([float(i % 90) for i in range(500)], 0.5)
