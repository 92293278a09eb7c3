import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from lakegauge.sources import sinks, tables
from lakegauge.sources.store import Conflict, Store, process, with_retry
from pyspark.sql import functions as F

KINDS = "k int, v int, p string"


def frame(spark, rows):
    return spark.createDataFrame(rows, KINDS)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 50)), min_size=1, max_size=8), min_size=1, max_size=3), st.booleans())
def test_merge_equals_a_dictionary(spark, tmp_path_factory, batches, update):
    store = Store(spark, f"file://{tmp_path_factory.mktemp('s')}/t", ["k"])
    want = {}
    for batch in batches:
        latest = {}
        for k, v in batch:
            latest[k] = max(v, latest.get(k, -1))
        want = {**want, **latest} if update else {**latest, **want}
        store.merge(frame(spark, [(k, v, "x") for k, v in batch]), ["v"], update=update)
    assert {r["k"]: r["v"] for r in store.read().collect()} == want


def test_versions_partitions_and_maintenance(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/t", ["k", "p"], ["p"], max_records=2)
    assert not store.exists() and store.version() == -1
    store.create(frame(spark, [(i, i, "a/b=c" if i % 2 else None) for i in range(9)]))
    with pytest.raises(Conflict):
        store.create(frame(spark, []))
    before = store.detail()["files"]
    store.merge(frame(spark, [(1, 100, "a/b=c"), (50, 1, "new")]), ["v"])
    assert {(r["k"], r["v"], r["p"]) for r in store.read().collect()} >= {(1, 100, "a/b=c"), (50, 1, "new"), (2, 2, None)}
    assert store.read().count() == 10 and store.read(0).count() == 9
    store.merge(frame(spark, [(1, 5, "a/b=c"), (3, 300, "a/b=c")]), ["v"], newer_only="v")
    assert {r["k"]: r["v"] for r in store.read().where("k in (1, 3)").collect()} == {1: 100, 3: 300}
    store.append(frame(spark, [(99, 9, "z")]))
    store.zorder("k", "v")
    store.optimize("k")
    assert store.read().count() == 11 and before > 1
    assert [r["operation"] for r in store.history().collect()] == ["optimize", "zorder", "append", "merge", "merge", "create"]
    assert store.vacuum() == 0 and store.vacuum(0) > 0 and store.read().count() == 11


def test_retry_passes_other_errors_on():
    seen = []

    def step():
        seen.append(1)
        raise FileNotFoundError("it does not exist") if len(seen) < 3 else KeyError("other")

    with pytest.raises(KeyError):
        with_retry(step, tries=5, wait=0.001)
    assert len(seen) == 3


def test_files_and_silos(spark, tmp_path):
    df = spark.range(40).selectExpr("id", "cast(id % 7 as string) device_id", "timestamp'2026-01-01 00:30:00' + make_interval(0,0,0,0,cast(id as int),0,0) metric_time", "'P' platform_customer_id", "'A' application_customer_id")
    sinks.hour_cache(df, f"{tmp_path}/cache")
    sinks.hour_cache(df.where("id < 2"), f"{tmp_path}/cache")
    assert tables.hour_cache(spark, f"{tmp_path}/cache", "2026-01-01 05:00:00", "2026-01-01 08:00:00", "P", "A").count() == 3
    assert sinks.silos(df, f"{tmp_path}/silos", per_silo=2) == 4 and spark.read.parquet(f"{tmp_path}/silos").count() == 40
    sinks.partitioned(df, f"{tmp_path}/parts", "device_id")
    sinks.batch(df, f"{tmp_path}/flat", files=2)
    df.selectExpr("id", "1 as prediction").coalesce(1).write.parquet(f"{tmp_path}/mixed/a")
    df.select("id").coalesce(1).write.parquet(f"{tmp_path}/mixed/b")
    assert tables.with_column_only(spark, f"{tmp_path}/mixed", "prediction").count() == 40
    assert tables.first_readable(spark, f"{tmp_path}/none", f"{tmp_path}/flat").count() == 40
    with pytest.raises(FileNotFoundError):
        tables.first_readable(spark, f"{tmp_path}/none")
    assert tables.newest_file(spark, f"{tmp_path}/flat").count() <= 40
    (tmp_path / "registry.json").write_text('{"d1": {"platform_customer_id": "P", "model": "m"}, "d2": {}}')
    assert {(r["device_id"], r["model"]) for r in tables.registry(spark, f"{tmp_path}/registry.json").collect()} == {("d1", "m"), ("d2", None)}
    state = sinks.Progress(spark, f"{tmp_path}/state.json")
    state.complete("a", 3), state.complete("a", 3)
    assert state.load() == {"completed": ["a"], "rows": 3}
    state.reset()
    assert state.load()["rows"] == 0


def test_text_and_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", "x\ty")], "key string, value string")
    sinks.tsv(df, f"{tmp_path}/t")
    assert {tuple(r) for r in spark.read.options(sep="\t", nullValue="\\N").schema("key string, value string").csv(f"{tmp_path}/t").collect()} == {("a", None), ("b", "x\ty")}
    sinks.predictions(df, f"{tmp_path}/p", "1"), sinks.predictions(df, f"{tmp_path}/p", "1")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 2
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("key string, value string").parquet(f"{tmp_path}/in")
    sinks.json_folder(stream, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    assert spark.read.json(f"{tmp_path}/out").count() == 2


def test_a_writer_that_worked_from_an_older_commit_gets_conflict(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    first, second = Store(spark, path, ["k"]), Store(spark, path, ["k"])
    first.create(frame(spark, [(1, 0, "x")]))
    write = Store._write

    def late(self, *args, **more):
        files = write(self, *args, **more)
        if self is second:
            monkeypatch.setattr(Store, "_write", write)
            first.merge(frame(spark, [(1, 1, "a")]), ["v"])  # commits between second's reading and its commit
        return files

    monkeypatch.setattr(Store, "_write", late)
    with pytest.raises(Conflict):
        second.merge(frame(spark, [(1, 2, "b")]), ["v"])
    assert [tuple(r) for r in first.read().collect()] == [(1, 1, "a")]
    with_retry(lambda: second.merge(frame(spark, [(1, 2, "b")]), ["v"]))
    assert [tuple(r) for r in first.read().collect()] == [(1, 2, "b")]
    assert second.vacuum(0) > 0 and first.read().count() == 1
    assert len([f for f in tmp_path.rglob("*.parquet")]) == first.detail()["files"]  # those of the failed commit are gone too


def test_columns_stay_when_a_frame_lacks_them(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/t", ["k"])
    store.create(frame(spark, [(1, 10, "x"), (2, 20, "y")]))
    store.append(spark.createDataFrame([(3, "new")], "k int, more string"))
    store.merge(spark.createDataFrame([(1, 11)], "k int, v int"), ["v"])
    assert sorted((r["k"], r["v"] or 0, r["p"] or "", r["more"] or "") for r in store.read().collect()) == [(1, 11, "x", ""), (2, 20, "y", ""), (3, 0, "", "new")]


def test_update_delete_expire_and_figures(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/t", ["k"], ["p"])
    store.create(frame(spark, [(i, i, f"2026-01-0{i % 3 + 1}") for i in range(9)]))
    others = {f for f in store.base()["files"] if "p=2026-01-01" not in f}
    store.update(F.col("k") == 3, {"v": F.lit(300)})
    assert others <= set(store.base()["files"])
    store.delete(F.col("k").isin(0, 4))
    assert sorted((r["k"], r["v"]) for r in store.read().collect()) == [(1, 1), (2, 2), (3, 300), (5, 5), (6, 6), (7, 7), (8, 8)]
    store.expire("p", "2026-01-02")
    assert sorted(r["k"] for r in store.read().collect()) == [1, 2, 5, 7, 8]
    assert store.delete(F.col("k") == 99) == store.version()
    done = process(store, frame(spark, [(1, 100, "2026-01-02"), (1, 50, "2026-01-02"), (50, 1, "2026-01-03")]), ["v"])
    assert (done["rows_in"], done["source_rows"], done["matched"], done["inserted"], done["match_ratio"], done["rows_after"]) == (3, 2, 1, 1, 0.5, 6)


def test_zorder_holds_within_partitions(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/t", ["k"], ["p"], max_records=25)
    store.create(frame(spark, [(i, (i * 37) % 100, "ab"[i % 2]) for i in range(200)]))
    store.zorder("v")
    spans = store.read().groupBy(F.input_file_name()).agg(F.min("v").alias("a"), F.max("v").alias("b")).collect()
    assert len(spans) >= 8 and all(r["b"] - r["a"] <= 40 for r in spans)


def test_a_key_that_moves_to_another_partition_stays_one_row(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/t", ["k"], ["p"])
    store.create(frame(spark, [(1, 1, "a"), (2, 2, "a"), (3, 3, "b"), (4, 4, None)]))
    untouched = {f for f in store.base()["files"] if "p=b" in f}
    store.merge(frame(spark, [(1, 10, "z"), (4, 40, "a")]), ["v"])
    assert sorted((r["k"], r["v"], r["p"]) for r in store.read().collect()) == [(1, 10, "z"), (2, 2, "a"), (3, 3, "b"), (4, 40, "a")]
    assert untouched <= set(store.base()["files"])
    store.merge(frame(spark, [(3, 9, "a"), (5, 5, "b")]), ["v"], update=False)
    assert sorted((r["k"], r["v"], r["p"]) for r in store.read().where("k >= 3").collect()) == [(3, 3, "b"), (4, 40, "a"), (5, 5, "b")]
    version = store.merge(frame(spark, [(1, 9, "y"), (2, 90, "y")]), ["v"], newer_only="v")
    assert {r["k"]: (r["v"], r["p"]) for r in store.read().where("k < 3").collect()} == {1: (10, "z"), 2: (90, "y")}
    assert store.numbers(version)["matched"] == 2


def test_a_text_that_names_a_version_is_no_reason_to_try_again():
    seen = []

    def step():
        seen.append(1)
        raise ValueError("unknown version of the schema")

    with pytest.raises(ValueError):
        with_retry(step, wait=0.001)
    assert len(seen) == 1
