import json
from datetime import date, datetime

import pytest
from lakegauge.plans import maintenance, pipelines
from lakegauge.sources import segments
from lakegauge.streaming import days, jobs
from pyspark.sql import functions as F

ROW = "device_id string, ts timestamp, value double"


def put(spark, path, rows):
    spark.createDataFrame([(d, datetime.fromisoformat(t) if t else None, v) for d, t, v in rows], ROW).coalesce(1).write.mode("append").parquet(path)


def run(spark, folder):
    stream = jobs.files(spark, f"{folder}/in", ROW, per_trigger=1)
    days.write_days(stream, f"{folder}/days", f"{folder}/late", f"{folder}/c").awaitTermination()
    read = lambda name, *c: sorted((tuple(r) for r in spark.read.parquet(f"{folder}/{name}").select(*c).collect()), key=str)
    return read("days", "device", "day", "n", "total", "least", "most"), read("late", "device", "ts", "value")


def test_days_are_written_once_and_late_rows_kept(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [("a", "2026-01-01 01:00:00", 1.0), ("a", "2026-01-01 02:00:00", 3.0), ("b", "2026-01-01 03:00:00", None), (None, "2026-01-01 03:00:00", 2.0), ("a", None, 5.0)])
    put(spark, f"{tmp_path}/in", [("a", "2026-01-03 01:00:00", 5.0)])
    put(spark, f"{tmp_path}/in", [("b", "2026-01-02 05:00:00", 7.0)])
    one = (("a", date(2026, 1, 1), 2, 4.0, 1.0, 3.0), ("b", date(2026, 1, 1), 1, 0.0, None, None), (None, date(2026, 1, 1), 1, 2.0, 2.0, 2.0))
    late = ("b", datetime(2026, 1, 2, 5), 7.0)
    assert run(spark, tmp_path) == (sorted(one, key=str), [late])
    assert run(spark, tmp_path) == (sorted(one, key=str), [late])
    put(spark, f"{tmp_path}/in", [("a", "2026-01-01 06:00:00", 9.0), ("z", "2026-01-09 06:00:00", None)])
    want = sorted([*one, ("a", date(2026, 1, 3), 1, 5.0, 5.0, 5.0)], key=str), sorted([late, ("a", datetime(2026, 1, 1, 6), 9.0)], key=str)
    assert run(spark, tmp_path) == want
    assert run(spark, tmp_path) == want


def test_devices_of_a_day_share_state_calls_and_timers(spark, tmp_path, monkeypatch):
    calls = tmp_path / "calls"
    calls.mkdir()

    class Counted(days._Days):
        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            (calls / str(key)).touch()
            yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)

    monkeypatch.setattr(days, "_Days", Counted)
    monkeypatch.setattr(days, "GROUPS", 4)
    put(spark, f"{tmp_path}/in", [(f"d{i}", f"2026-01-01 0{i % 9}:00:00", float(i)) for i in range(300)])
    put(spark, f"{tmp_path}/in", [("z", "2026-01-05 01:00:00", 5.0)])
    put(spark, f"{tmp_path}/in", [("d7", "2026-01-01 05:00:00", 7.0), ("new", "2026-01-01 06:00:00", None)])
    whole, late = run(spark, tmp_path)
    # d7's day is open until the batch's timers fire; a device without a row of the day is late beside it
    assert sorted(whole) == sorted((f"d{i}", date(2026, 1, 1), 1 + (i == 7), i * (1.0 + (i == 7)), float(i), float(i)) for i in range(300))
    assert late == [("new", datetime(2026, 1, 1, 6), None)]
    assert 1 <= len(list(calls.iterdir())) <= 4


def test_a_compacted_table_has_few_files_at_any_size(spark, tmp_path, monkeypatch):
    made = []

    class Seen(maintenance.Store):
        def __init__(self, *a, **k):
            super().__init__(*a, **k)
            made.append(self)

    monkeypatch.setattr(maintenance, "Store", Seen)
    spark.range(40_000).selectExpr("id as event_id", "id as user_id", "cast(id % 2 as string) as event_type").write.parquet(f"{tmp_path}/events.parquet")
    found = maintenance.stream_compaction(spark, str(tmp_path))
    assert found.count() == 40_000 and found.where("compacted").count() == 40_000
    files = made[0].detail()["files"]
    assert 100 <= files <= 300  # a thousand of 40 rows before


def test_files_of_a_delivery_grow_in_number_and_not_in_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pipelines, "FILE_ROWS", 100)
    for kind, order in (("parquet", ()), ("json", ("id",))):
        each = pipelines.landed(spark.range(1000), f"{tmp_path}/{kind}", 2, *order, kind=kind)
        held = spark.read.schema("id long").format(kind).load(f"{tmp_path}/{kind}")
        sizes = [r["count"] for r in held.groupBy(F.input_file_name()).count().collect()]
        assert each == 5 and len(sizes) == 10 and sum(sizes) == 1000 and max(sizes) <= 150
    (tmp_path / "sf").mkdir()
    spark.range(1000).selectExpr("id as event_id", "id % 9 as user_id").write.parquet(f"{tmp_path}/sf/events.parquet")
    sizes, landed = [], pipelines.landed
    monkeypatch.setattr(pipelines, "FILES", 4)
    monkeypatch.setattr(pipelines, "landed", lambda rows, path, *a, **k: (landed(rows, path, *a, **k), sizes.extend(r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()))[0])
    found = pipelines.stream_split_sinks(spark, f"{tmp_path}/sf")
    assert sorted(map(tuple, found.collect())) == [("bad", 875), ("good", 125)] and len(sizes) == 10 and max(sizes) <= 150


def fill(spark, folder, n=2500, **options):
    rows = spark.range(n).selectExpr("cast(id % 5 as string) as key", "cast(id as string) as value", "timestamp_seconds(id) as timestamp")
    rows.repartition(2).write.parquet(f"{folder}/in")
    stream = jobs.files(spark, f"{folder}/in", "key string, value string, timestamp timestamp", per_trigger=1)
    segments.write(stream, f"{folder}/log", "t", f"{folder}/w", partitions=4, **options).awaitTermination()
    return f"{folder}/log"


def test_a_topic_holds_every_record_once_and_a_key_has_one_partition(spark, tmp_path):
    log = fill(spark, tmp_path, batch=300)
    ends = segments.ends(log, "t")
    assert sum(ends.values()) == 2500
    for p, own in segments.listed(log, "t").items():
        assert [a for a, _ in own] == [0, *[a + n for a, n in own][:-1]]
        assert all(n <= 300 for _, n in own) and p in range(4)
    rows = spark.read.schema("key string, value string, at long").json(f"{log}/t/[0-9]*").withColumn("p", F.regexp_extract(F.input_file_name(), "/t/([0-9]+)/", 1))
    assert rows.groupBy("key").agg(F.countDistinct("p").alias("n")).where("n <> 1").count() == 0
    assert rows.select("value").distinct().count() == 2500
    assert not list((tmp_path / "log/t/_staged").iterdir())


def test_a_failed_batch_is_read_again_with_the_same_offsets(spark, tmp_path):
    log, seen = fill(spark, tmp_path), []

    def step(df, batch_id):
        got = sorted((r["partition"], r["offset"]) for r in df.collect())
        seen.append((batch_id, got))
        if len(seen) == 3:
            raise RuntimeError("lost")

    def start():
        records = segments.stream(spark, log, "t", checkpoint=f"{tmp_path}/r", per_trigger=400, starting="earliest")
        segments.drained(records.writeStream.foreachBatch(step).option("checkpointLocation", f"{tmp_path}/r").trigger(processingTime="0 seconds").start(), log, "t")

    with pytest.raises(Exception, match="lost"):
        start()
    start()
    assert seen[2] == seen[3] and all(len(got) <= 400 for _, got in seen)
    whole = [x for i, (_, got) in enumerate(seen) if i != 2 for x in got]
    assert len(whole) == len(set(whole)) == 2500


def test_a_stream_from_the_latest_offset_sees_new_records_alone(spark, tmp_path):
    log = fill(spark, tmp_path, 100)
    reader = segments.Reader({"path": log, "topics": "t"})
    assert reader.initialOffset() == reader.latestOffset() == {"t": {str(p): n for p, n in segments.ends(log, "t").items()}}
    parts = reader.partitions({"t": {"0": 0, "1": 5}}, {"t": {"0": 20, "1": 9}})
    assert sum(p.last - p.first for p in parts) == 24 and max(p.last - p.first for p in parts) <= 2


def test_what_waits_at_a_start_takes_so_many_triggers_and_a_range_knows_its_segments(tmp_path, monkeypatch):
    writer = segments.Writer({"path": str(tmp_path), "topic": "t", "partitions": "3", "batch": "100"})
    writer.commit([writer.write(FakeRow(key=str(i), value=str(i), timestamp=None) for i in range(2000))], 0)
    assert sum(len(own) for own in segments.listed(str(tmp_path), "t").values()) <= 2000 / 100 + 3
    reader, now, triggers, seen = segments.Reader({"path": str(tmp_path), "topics": "t", "startingoffsets": "earliest", "maxoffsetspertrigger": "10", "backlogtriggers": "4"}), {"t": {}}, 0, []
    while (then := reader.latestOffset()) != now:
        ranges = reader.partitions(now, then)
        with monkeypatch.context() as m:
            m.setattr(segments, "listed", None)  # tasks list nothing
            got = [r[4] for p in ranges for r in reader.read(p)]
        assert len(got) <= 500 and all(p.segments for p in ranges)
        seen, now, triggers = seen + got, then, triggers + 1
    assert triggers <= 5 and sorted(map(int, seen)) == list(range(2000))



class FakeRow(dict):
    asDict = dict.copy


def staged(writer, values):
    return writer.write(FakeRow(key="k", value=v, timestamp=None) for v in values)


def test_commits_are_of_two_phases(tmp_path):
    writer = segments.Writer({"path": str(tmp_path), "topic": "t", "partitions": "1", "batch": "3"})
    lost = staged(writer, ["x", "y"])  # a task that ran twice; its first run's files have no commit
    kept = staged(writer, ["x", b"\xff", None, "z", "w"])
    writer.commit([kept, None], 0)
    assert segments.ends(str(tmp_path), "t") == {0: 3}
    again = staged(writer, ["x", "z", "w"])
    writer.commit([again], 0)  # a batch that is run again after its commit
    assert segments.ends(str(tmp_path), "t") == {0: 3}
    writer.abort([staged(writer, ["never"])], 1)
    assert segments.ends(str(tmp_path), "t") == {0: 3} and not (tmp_path / "t/_staged" / lost.folder).exists()
    letters = [json.loads(x) for f in segments.dead(str(tmp_path), "t") for x in (tmp_path / "t/_dead" / f).read_text().splitlines()]
    assert sorted((x["key"], x["value"]) for x in letters if x["value"]) == [("k", "/w==")] and len(letters) == 2


def test_a_commit_that_broke_off_is_finished_by_its_plan(tmp_path, monkeypatch):
    writer = segments.Writer({"path": str(tmp_path), "topic": "t", "partitions": "1", "batch": "2"})
    first, moved = staged(writer, list("abcdef")), []
    replace = segments.os.replace

    def fails(a, b):
        if len(moved) == 2:
            raise OSError("lost")
        moved.append(b)
        replace(a, b)

    monkeypatch.setattr(segments.os, "replace", fails)
    with pytest.raises(OSError):
        writer.commit([first], 0)
    writer.abort([first], 0)  # as Spark does when a commit fails
    monkeypatch.setattr(segments.os, "replace", replace)
    writer.commit([staged(writer, list("abcdef"))], 0)  # the batch is run again
    assert segments.ends(str(tmp_path), "t") == {0: 6}
    lines = [json.loads(x)["value"] for f in sorted((tmp_path / "t/0").iterdir()) for x in f.read_text().splitlines()]
    assert lines == list("abcdef")
