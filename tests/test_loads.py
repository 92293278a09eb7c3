import math

import pytest
from lakegauge.operators import health, series, telemetry
from lakegauge.plans import maintenance
from lakegauge.sources import sinks, tables
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_a_load_reads_only_partitions_from_the_least_mark_on(spark, tmp_path):
    events = maintenance._by_day(spark, SF)
    sinks.partitioned(events, f"{tmp_path}/e", "day")
    stored = spark.read.schema(events.schema).parquet(f"{tmp_path}/e")
    load = telemetry.newer_than(stored, maintenance._marks(events), "user_id", "ts", "last_time", partition="day")
    plan = load._jdf.queryExecution().executedPlan().toString()
    day = telemetry.cutoff(maintenance._marks(events), "last_time")
    assert f">= {day})" in plan.split("PartitionFilters: [")[1].split("]")[0]
    none = events.limit(0).select("user_id", "ts").withColumnRenamed("ts", "last_time")
    assert telemetry.newer_than(stored, none, "user_id", "ts", "last_time", partition="day").count() == events.count()
    assert telemetry.backfill(stored, none, "user_id", "last_time", "day").count() == 0


def test_hybrid_latest_golden_values(spark):
    rows = [("d", f"2026-01-0{i} 00:00:00", v) for i, v in ((1, 1.0), (5, 100.0), (6, 200.0))]
    live = spark.createDataFrame(rows + [("d", "2026-01-07 00:00:00", 300.0)], "device string, t string, watts double").withColumn("t", telemetry.F.to_timestamp("t"))
    cache = live.where("watts < 300")
    found = telemetry.latest_hybrid(cache, live, "device", "t", 3, [telemetry.F.desc("t")])
    assert sorted(r["watts"] for r in found.collect()) == [200.0, 300.0]  # 3 // 288 + 1 days of the cache: one
    wide = telemetry.latest_hybrid(cache, live, "device", "t", 3, [telemetry.F.desc("t")], per_day=1)
    assert sorted(r["watts"] for r in wide.collect()) == [100.0, 200.0, 300.0]
    assert telemetry.latest_hybrid(cache.limit(0), live, "device", "t", 2, [telemetry.F.desc("t")]).count() == 2


def test_files_are_listed_and_not_read(spark, tmp_path):
    assert not tables.ready(spark, f"file://{tmp_path}/none")
    for i in range(3):
        spark.range(i, i + 1).coalesce(1).write.parquet(f"file://{tmp_path}/in/{i}")
    assert tables.ready(spark, f"file://{tmp_path}/in")
    assert [r["id"] for r in tables.newest_file(spark, f"file://{tmp_path}/in").collect()] == [2]
    spark.range(1).selectExpr("id", "cast(null as int) as extra").coalesce(1).write.parquet(f"file://{tmp_path}/in/x")
    assert tables.with_column_only(spark, f"file://{tmp_path}/in", "extra").count() == 1
    with pytest.raises(FileNotFoundError):
        tables.with_column_only(spark, f"file://{tmp_path}/in", "other")
    with pytest.raises(FileNotFoundError):
        tables.newest_file(spark, f"file://{tmp_path}/none")


def test_artifacts_and_categories(spark, tmp_path):
    with pytest.raises(ValueError):
        health.Preprocessor.fit(spark.range(5).selectExpr("cast(id as string) as c"), [], ["c"], most=3)
    sinks.write_text(spark, f"file://{tmp_path}/a.json", "{}")
    with pytest.raises(ValueError):
        health.Artifacts.load(spark, f"file://{tmp_path}/a.json")


def recursion(rows, rho):
    """x of (group, order, e) rows by a plain loop."""
    found, last = {}, {}
    for g, o, e in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        last[g] = last.get(g, 0.0) * rho + (e or 0.0)
        found[g, o] = last[g]
    return found


@pytest.mark.parametrize("rho", [0.9, 0.7, 0.9995, 1.0, 0.0, -0.5, -1.0, -1.2, 1.01])
def test_recursion_over_groups_and_partitions(spark, rho):
    rows = [(0, i, float(i % 7)) for i in range(9000)] + [(1, i, None if i % 3 else 1.0) for i in range(500)] + [(None, i, 1.0) for i in range(5)] + [(i, 0, 2.0) for i in range(2, 60)]
    df = spark.createDataFrame(rows, "g int, o int, e double").repartition(6)
    want = recursion(rows, rho)
    found = {(r["g"], r["o"]): r["x"] for r in series.autoregressive(df, "g", "o", "e", rho).collect()}
    assert found.keys() == want.keys()
    for k, x in want.items():
        assert found[k] == (x if math.isinf(x) else pytest.approx(x, rel=1e-9, abs=1e-9)), (k, found[k], x)


def test_recursion_over_a_million_rows_of_a_group(spark):
    df = spark.range(1_000_000).selectExpr("0 as g", "id as o", "1D as e").repartition(8)
    for rho, last in ((1.0, 1_000_000.0), (0.9995, 2000.0)):
        made = series.autoregressive(df, "g", "o", "e", rho)
        assert made.agg(F.max("x")).collect()[0][0] == pytest.approx(last, rel=1e-9)
        assert "Window" not in made._jdf.queryExecution().executedPlan().toString()
    assert series.autoregressive(df.limit(0), "g", "o", "e").collect() == []


def test_only_files_with_a_column_are_read(spark, tmp_path):
    for i in range(7):
        spark.range(3).selectExpr("id", *(["id as wanted"] if i % 2 else [])).coalesce(1).write.parquet(f"{tmp_path}/d/{i}")
    assert tables.with_column_only(spark, f"{tmp_path}/d", "wanted").count() == 9


def test_a_cursor_gives_rows_in_order_with_few_held(spark):
    df = spark.range(5000).selectExpr("id * 7919 % 5003 as k", "id % 3 as g").repartition(6)
    batches = list(tables.cursor(df, "g", "k", rows=700))
    rows = [tuple(r) for b in batches for r in b]
    assert [len(b) for b in batches] == [700] * 7 + [100]
    assert [(g, k) for k, g in rows] == sorted((i % 3, i * 7919 % 5003) for i in range(5000))
    assert next(tables.cursor(df, "k", rows=3))[0]["k"] == 0 and list(tables.cursor(df.limit(0), "k")) == []
