import random
from collections import Counter

import numpy as np
import pytest
from lakegauge.operators import frequent, quality, sketches
from lakegauge.plans import registry, relational  # noqa: F401
from pyspark.sql import functions as F


def counted(rows, n, least=1):
    return sorted(((k, c) for k, c in Counter(rows).items() if c >= least), key=lambda x: (-x[1], x[0]))[:n]


@pytest.mark.parametrize("counters", [3, 20, 4096])
@pytest.mark.parametrize("kind", ["skewed", "ties", "distinct", "empty"])
def test_top_keys_are_exact(spark, counters, kind):
    rng = random.Random(3)
    keys = {"skewed": [int(rng.paretovariate(0.6)) % 5000 for _ in range(6000)], "ties": [i % 50 for i in range(2000)], "distinct": list(range(1500)), "empty": []}[kind]
    df = spark.createDataFrame([(k, str(k % 3)) for k in keys], "a int, b string").repartition(5)
    for n, least in ((20, 1), (5, 2)):
        found = frequent.top_keys(df, ["a", "b"], n, least, counters)
        assert [((r["a"], r["b"]), r["n_rows"]) for r in found.collect()] == counted([(k, str(k % 3)) for k in keys], n, least)


def test_nulls_are_keys(spark):
    df = spark.createDataFrame([(None, 1)] * 3 + [(1, None)] * 2 + [(1, 1)], "a int, b int")
    assert [tuple(r) for r in quality.duplicates(df, ["a", "b"]).collect()] == [(None, 1, 3), (1, None, 2)]


def test_summaries_bound_every_count():
    rng = np.random.default_rng(5)
    keys = (rng.pareto(0.7, 30_000) * 3).astype(np.int64) % 3000
    parts = [frequent.Summary(40) for _ in range(4)]
    for i, part in enumerate(np.array_split(keys, 40)):
        parts[i % 4].add(part)
    whole = frequent.Summary(40)
    for p in parts:
        whole.add(p.key, p.n, p.error)
    seen = dict(zip(whole.key.tolist(), whole.n.tolist()))
    assert len(seen) <= 40 and whole.error <= len(keys) / 40
    for key, n in Counter(keys.tolist()).items():
        assert seen.get(key, 0) <= n <= seen.get(key, 0) + whole.error


def test_only_likely_keys_are_shuffled(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 10).otherwise(F.col("id")).alias("k")).repartition(4)
    found = frequent.top_keys(df, ["k"], 5)
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [(k, 20_000) for k in (0, 2, 4, 6, 8)]


def test_days_of_hours_equal_days_of_rows(spark):
    df = spark.range(40_000).selectExpr("timestamp_seconds(id * 13) as ts", "id * 7919 % 9001 as device", "if(id % 3 = 0, null, id * 7919 % 9001) as sparse", "CASE WHEN id % 50 = 0 THEN NULL WHEN id % 51 = 0 THEN double('NaN') ELSE (id * 104729 % 20011) / 7.0D - 900 END as v")
    day, hour = F.to_date("ts"), F.date_trunc("hour", "ts")
    hours = sketches.registers(df.repartition(5), [], hour, "device")
    days, rows = sketches.merged_registers(hours, [], F.to_date("bucket")), sketches.registers(df, [], day, "device")
    assert days.exceptAll(rows).count() == 0 and rows.exceptAll(days).count() == 0
    days = sketches.distinct_estimates(days, [])
    exact = {r[0]: r[1] for r in df.groupBy(day).agg(F.countDistinct("device")).collect()}
    assert all(abs(r["distinct"] - exact[r["bucket"]]) <= 1 + 0.09 * exact[r["bucket"]] for r in days.collect())
    of_hours, of_rows = sketches.merged_cells(sketches.cells(df, [], hour, "v"), [], F.to_date("bucket")), sketches.cells(df.repartition(3), [], day, "v")
    assert of_hours.exceptAll(of_rows).count() == 0 and of_rows.exceptAll(of_hours).count() == 0
    values = {}
    for r in df.select(day.alias("d"), "v").where("v is not null and not isnan(v)").collect():
        values.setdefault(r["d"], []).append(r["v"])
    for share in (0.0, 0.3, 0.99, 1.0):
        for r in sketches.cell_quantiles(of_hours, [], share).collect():
            own = sorted(values[r["bucket"]])
            want = own[int(share * (len(own) - 1))]
            assert r["n"] == len(own) and abs(r["quantile"] - want) <= 0.0101 * abs(want)
    medians = sketches.merged_ranks(sketches.ranks(df.where("v is not null and not isnan(v)"), [], hour, "v"), [], F.to_date("bucket"))
    for r in medians.select("bucket", sketches.rank_quantile(0.25).alias("q")).collect():
        own = values[r["bucket"]]
        assert abs(sum(v <= r["q"] for v in own) / len(own) - 0.25) <= 5 / sketches.RANK_K


@pytest.mark.parametrize("n", [0, 1, 100, 3000, 12_000, 400_000])
def test_distinct_estimates_are_within_five_errors(spark, n):
    df = spark.range(2 * n).selectExpr(f"id % greatest(1, {n}) as v", "0 as g").unionByName(spark.createDataFrame([(None, 0)], "v long, g int"))
    found = sketches.distinct_estimates(sketches.registers(df, ["g"], F.lit(1), "v"), ["g"]).collect()
    assert [abs(r["distinct"] - n) <= 0.08 * n + 1 for r in found] == [True] * (n > 0)


def test_one_sketch_a_group_and_not_one_a_device(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("cast(id % 2 as string) as event_type", "if(id % 7 = 0, null, id div 2) as user_id")
    rows.unionByName(rows.limit(10)).write.parquet(f"{tmp_path}/events.parquet")
    found = registry.QUERIES["approximate_distinct"](spark, str(tmp_path))
    assert sorted((r["event_type"], r["devices"], r["near"]) for r in found.collect()) == [(str(k), sum(i % 7 > 0 for i in range(k, 20_000, 2)), True) for k in range(2)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    sketched = [line for line in plan.splitlines() if "approx_count_distinct" in line]
    assert sketched and not any("user_id" in line.split("keys=[")[1].split("]")[0] for line in sketched)
