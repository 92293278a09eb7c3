import numpy as np
import pytest
from lakegauge import schemas
from lakegauge.functions import scalar
from lakegauge.operators import generate, health, quality, records, telemetry
from lakegauge.plans import operations, pipelines
from lakegauge.streaming import jobs
from pyspark.sql import functions as F

CASES = {
    '{"device_id":"a","data":{"PowerDetail":[{"Average":1}]},"inventory_data":{"socket_count":4}}': "VALID",
    '{"device_id":"a","data":{"PowerDetail":[{"Average":1}]},"inventory_data":{"socket_count":"4"}}': "INVALID_SOCKET_COUNT",
    '{"device_id":null,"data":{"PowerDetail":[]},"inventory_data":{"socket_count":4}}': "MISSING_DEVICE_ID",
    '{"device_id":"a","data":{"PowerDetail":[]}}': "INVALID_SOCKET_COUNT",
    '{"device_id":"a","inventory_data":{"socket_count":4}}': "MISSING_POWERDETAIL",
    '{"device_id":"a","data":{"PowerDetail":[{"Average":"x"}]},"inventory_data":{"socket_count":4}}': "VALID",
    '{"device_id":"a","data":{"PowerDetail":[]},"inventory_data":{"socket_count":4.5}}': "INVALID_SOCKET_COUNT",
    '{"device_id":"a","data":{"PowerDetail":[]},"inventory_data":{"socket_count":9999999999}}': "INVALID_SOCKET_COUNT",
    "{oops": "MISSING_DEVICE_ID",
    "[1]": "MISSING_DEVICE_ID",
    "7": "MISSING_DEVICE_ID",
    '[{"device_id":"a","data":{"PowerDetail":[]},"inventory_data":{"socket_count":4}}]': "MISSING_DEVICE_ID",
    "": "INVALID_SCHEMA",
    "  ": "INVALID_SCHEMA",
}


def test_classes_of_golden_records(spark):
    df = spark.createDataFrame([*CASES.items(), (None, "INVALID_SCHEMA")], "value string, want string")
    rows = records.classified(df, schemas.GOLDEN).collect()
    assert [r["error_type"] for r in rows] == [r["want"] for r in rows]
    assert all((r["parsed"] is not None) == (r["want"] == "VALID") for r in rows)


def test_batches_and_streams_have_one_rule(spark, tmp_path):
    df = spark.createDataFrame([*CASES.items(), (None, "INVALID_SCHEMA")], "value string, want string")
    df.repartition(2).write.parquet(f"{tmp_path}/in")
    stream = jobs.parse(jobs.files(spark, f"{tmp_path}/in", "value string, want string", per_trigger=1), schemas.GOLDEN)
    stream.select("want", "error_type").writeStream.format("memory").queryName("classes").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    found = spark.table("classes").collect()
    assert len(found) == len(CASES) + 1 and all(r["want"] == r["error_type"] for r in found)


def test_readings_and_drift_of_records(spark):
    texts = ['{"device_id":1,"data":{"PowerDetail":[{"Average":1.5},{"Average":"x"},{},7,{"Average":2,"new":[1]}]},"inventory_data":{"socket_count":4}}', "{oops", None, '{"device_id":"b","data":{"PowerDetail":[]},"inventory_data":{"socket_count":"4"}}']
    rows = records.classified(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert [r["Average"] for r in records.readings(rows).orderBy("position").collect()] == [1.5, None, None, None, 2.0]
    shapes = {r["error_type"]: (r["n"], r["shape"]) for r in records.drift(rows, "error_type").collect()}
    assert set(shapes) == {"VALID", "INVALID_SOCKET_COUNT"} and "socket_count: STRING" in shapes["INVALID_SOCKET_COUNT"][1] and "ARRAY<VARIANT>" in shapes["VALID"][1]


def test_repair_needs_every_step(spark):
    record = '{"created_at":"%s","inventory_data":{"socket_count":"%s"}}'
    rows = [(record % ("02/01/2026 03:04:05", "4"), "INVALID_SOCKET_COUNT", 0), (record % ("never", "4"), "INVALID_SOCKET_COUNT", 0), (record % ("2026-01-02T00:00:00Z", "x"), "INVALID_SOCKET_COUNT", 0), (record % ("2026-01-02", "4"), "INVALID_SOCKET_COUNT", 3), ("{}", "MISSING_DEVICE_ID", 0), (None, "INVALID_SCHEMA", 0)]
    found = telemetry.route(spark.createDataFrame(rows, "raw string, error_type string, attempts int")).collect()
    assert [r["route"] for r in found] == ["retry"] + ["failure"] * 5
    assert found[0]["sockets"] == 4 and str(found[0]["time"]) == "2026-01-02 03:04:05"


def test_power_detail_of_three_readings(spark):
    df = spark.createDataFrame([("d", f"t{i}", 100.0 * i, 100.0 * i - 10, 100.0 * i + 50) for i in (2, 3, 1)] + [("e", "t", None, None, None)], "device string, t string, v double, lo double, hi double")
    rows = {r["device"]: r for r in telemetry.power_detail(df, ["device"], "t", "v", "lo", "hi").collect()}
    assert (rows["d"]["Average"], rows["d"]["Minimum"], rows["d"]["Maximum"]) == (200.0, 90.0, 350.0)
    assert [p["Time"] for p in rows["d"]["PowerDetail"]] == ["t1", "t2", "t3"] and rows["e"]["Average"] == 0


def test_late_rows_are_dropped_by_windows(spark, tmp_path):
    for i, t in enumerate(["2026-01-10 00:00:00", "2026-01-12 00:00:00", "2026-01-12 06:00:00", "2026-01-01 00:00:00", "2026-01-20 00:00:00", "2026-01-22 00:00:00"]):
        spark.createDataFrame([(t, 1.0)], "t string, v double").selectExpr("cast(t as timestamp) t", "v").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema("t timestamp, v double").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    windows = jobs.by_window(stream, "t", "1 day", [], [F.count("*").alias("n")], late="1 hour")
    windows.writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    days = {str(r["window_start"])[:10]: r["n"] for r in spark.table("late").collect()}
    assert days == {"2026-01-10": 1, "2026-01-12": 2, "2026-01-20": 1}
    gaps = jobs.sessions(spark.read.parquet(f"{tmp_path}/in/*"), "t", "12 hours", [], [F.count("*").alias("n")], late="1 hour")
    assert sorted(r["n"] for r in gaps.collect()) == [1, 1, 1, 1, 2]


def test_scalars(spark):
    df = spark.createDataFrame([("16GB x 4", "a, b,,c "), ("none", None)], "m string, ids string")
    rows = df.select(scalar.first_number(F.col("m")).alias("n"), scalar.id_list(F.col("ids")).alias("l")).collect()
    assert [tuple(r) for r in rows] == [(16.0, ["a", "b", "c"]), (None, None)]
    keys = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "b", "")], "x string, y string, z string").select(scalar.key_hash("x", "y", "z").alias("k")).distinct()
    assert keys.count() == 3


def test_prepare_and_defaults(spark):
    df = spark.createDataFrame([("1.5", None, float("nan"), None), ("x", "e", 2.0, "k")], "a string, error_reason string, v double, extra string")
    rows = telemetry.prepare(df, {"a": "double", "error_reason": "string", "v": "double", "t": "timestamp"}, ["error_reason"]).collect()
    assert [(r["a"], r["error_reason"], r["v"]) for r in rows] == [(1.5, None, 0.0), (0.0, "e", 2.0)] and rows[0]["t"].year == 1970


def test_forest_ranks_outliers_low(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(600, 2)))] + [(1000, 9.0, 9.0), (1001, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    forest = health.IsolationForest(trees=60).fit(df, ["a", "b"])
    scores = {r["id"]: r["anomaly_score"] for r in forest.score(df).collect()}
    assert scores[1001] is None and scores[1000] == min(v for v in scores.values() if v is not None)
    assert all(-0.5 <= v <= 0.5 for v in scores.values() if v is not None)
    again = health.IsolationForest(trees=60).fit(df, ["a", "b"]).score(df).where("id = 1000").collect()[0]["anomaly_score"]
    assert again == scores[1000]


def walked(tree, row):
    """The path length of one row in one tree, step by step."""
    feature, cut, left, right, depth = tree
    at = 0
    while feature[at] >= 0:
        at = left[at] if row[feature[at]] < cut[at] else right[at]
    return depth[at]


def test_forest_is_the_same_for_any_partitions_and_scores_as_plain_trees(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(3000, 2)))]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    one = health.IsolationForest(trees=40, sample=64).fit(df, ["a", "b"], ["id"])
    two = health.IsolationForest(trees=40, sample=64).fit(df.repartition(13), ["a", "b"], ["id"])
    assert len(one.nodes) == 40 and all((x == y).all() for a, b in zip(one.nodes, two.nodes) for x, y in zip(a, b))
    x = rng.normal(size=(500, 2)) * 3
    want = [np.mean([walked(t, r) for t in one.nodes]) for r in x]
    assert np.abs(one.depths(x) - want).max() < 1e-12
    # a tree sees rows of the whole table, and no two trees the same ones
    cuts = {float(t[1][0]) for t in one.nodes}
    assert len(cuts) > 35
    empty = health.IsolationForest(trees=5).fit(df.limit(0), ["a", "b"])
    assert empty.nodes == [] and empty.score(df).count() == 3000


def test_health_guards(spark):
    one = spark.createDataFrame([("d", 1, 5.0, 0.1), ("e", 2, 5.0, 0.1)], "device_id string, hour_of_day int, avg_metric_value double, anomaly_score double")
    r = health.health(one).collect()[0]
    assert (r["ahc"], r["dhc"], r["tcc"], r["health_score"]) == (50.0, 100.0, 100.0, 75.0) and r["health_status"] == "Warning"
    with pytest.raises(ValueError):
        health.features(one)


def test_preprocessor_unknown_category(spark):
    fit = health.Preprocessor.fit(spark.createDataFrame([(1.0, "a"), (3.0, "b"), (None, "b")], "x double, c string"), ["x"], ["c"])
    rows = fit.transform(spark.createDataFrame([(2.0, "z"), (None, None)], "x double, c string")).collect()
    assert [(r["x_x"], r["x_c"]) for r in rows] == [(0.0, -1.0), (0.0, 1.0)]


def test_quality_of_empty_tables(spark):
    none = spark.createDataFrame([], "k int, v double")
    assert quality.guard(none, "v").collect()[0]["passed"] is False
    assert quality.duplicates(none, ["k"]).collect() == [] and quality.outliers(none, "v").collect() == []
    assert quality.mismatches(none, spark.createDataFrame([(1, 2.0)], "k int, v double"), ["k"], "v").count() == 1


def test_generators_do_not_depend_on_partitions(spark):
    a = generate.daily_file(spark, 3, "2026-01-02")
    assert a.exceptAll(generate.daily_file(spark, 3, "2026-01-02").repartition(7)).count() == 0
    assert generate.daily_file(spark, 3, "2026-01-02").select("device_id", "metric_time").distinct().count() == 3 * 2016


def test_stream_parse_tells_wrong_types_from_broken_json(spark):
    from lakegauge.plans import pipelines

    rows = spark.range(16).selectExpr("id AS event_id", "id AS user_id").withColumn("value", F.expr(pipelines._RAW)).withColumn("want", F.expr(pipelines._CLASS))
    found = jobs.parse(rows, pipelines._RECORD).collect()
    assert len(found) == 16 and all(r["error_type"] == r["want"] for r in found)
    odd = spark.createDataFrame([("5",), ('"x"',), ("[]",)], "value string")
    assert {r["error_type"] for r in jobs.parse(odd, pipelines._RECORD).collect()} == {"MISSING_DEVICE_ID"}


def test_files_are_folders_of_parts_that_no_task_gathers(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 1200, 1, 4)
    rows.withColumn("file", F.col("id") % 3).write.partitionBy("file").parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    sizes = [f.stat().st_size for f in tmp_path.glob("t/file=*/*.parquet")]
    one = quality.file_statistics(df, F.lit(100), F.regexp_extract("_metadata.file_path", "^(.*/file=[0-9]+)/", 1)).collect()[0]
    assert (one["files"], one["n_rows"], one["bytes"]) == (3, 1200, sum(sizes)) and len(sizes) == 12
    assert quality.file_statistics(df, F.lit(100)).collect()[0]["files"] == 12
    (tmp_path / "sf").mkdir()
    monkeypatch.setattr(pipelines, "FILE_ROWS", 100)
    spark.range(0, 1200, 1, 4).write.parquet(f"{tmp_path}/sf/lineitem.parquet")
    found = operations.file_statistics(spark, f"{tmp_path}/sf")
    assert tuple(found.collect()[0]) == (1200, 3, True)
    parts = found.inputFiles()
    assert len(parts) == 12 and all(spark.read.parquet(p).count() <= 150 for p in parts)
