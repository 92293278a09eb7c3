"""Each device's day once, when it is over, and late rows beside it: arbitrary state with event-time timers.

State is kept by (group of devices, day): a table of count, sum and extremes of each device, as one Arrow
message, so a call to the state store and a timer serve a group's devices together; by device and day they
were what took the time. GROUPS bounds the states of a day, and a state grows with devices / GROUPS. The
first row of a group's day sets a timer at the day's end; when the watermark passes it the days' rows leave
and the state goes. A row of a day whose end the watermark has passed, of a device that has no state any
more, is late; it leaves as it came, so what is on time and what is late are together the input. Spark
itself would drop such rows before they reach the state by the time column, which is why they come without
it, as microseconds.
"""

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import ship

_DAY_MS = 86_400_000
_OUT = "kind string, device string, day date, n long, total double, least double, most double, ts timestamp, value double"
_COLUMNS = [c.split()[0] for c in _OUT.split(", ")]
_STATE = pa.schema([("device", pa.string()), ("n", pa.int64()), ("total", pa.float64()), ("least", pa.float64()), ("most", pa.float64())])
#: Groups of devices; a checkpoint holds for the number that it was begun with.
GROUPS = 256


class _Days(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "devices binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        day = int(key[1])
        end, before = (day + 1) * _DAY_MS, self.seen.get() if self.seen.exists() else None
        held = now = _unpacked(before[0]) if before else None
        over = timerValues.getCurrentWatermarkInMs() >= end
        for part in rows:
            if over:
                late = ~part["device"].isin(held["device"]) if held is not None else pd.Series(True, part.index)
                if late.any():
                    gone, part = part[late], part[~late]
                    yield pd.DataFrame({"kind": "late", "device": gone["device"], "day": _date(day), "n": 1, "total": None, "least": None, "most": None, "ts": pd.to_datetime(gone["at"], unit="us"), "value": gone["value"]})[_COLUMNS]
            if len(part):
                made = part.groupby("device", dropna=False)["value"].agg(n="size", total="sum", least="min", most="max").reset_index()
                now = made if now is None else pd.concat([now, made]).groupby("device", dropna=False).agg({"n": "sum", "total": "sum", "least": "min", "most": "max"}).reset_index()
        if now is not held:
            if held is None:
                self.handle.registerTimer(end)
            self.seen.update((_packed(now),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            held = _unpacked(self.seen.get()[0])
            self.seen.clear()
            yield held.assign(kind="day", day=_date(int(key[1])), ts=pd.NaT, value=None)[_COLUMNS]

    def close(self) -> None:
        pass


def _date(day: int):
    return pd.Timestamp(day * _DAY_MS, unit="ms").date()


def _packed(devices: pd.DataFrame) -> bytes:
    table = pa.table([pa.array(devices[f.name].to_numpy(), f.type, from_pandas=True) for f in _STATE], schema=_STATE)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _STATE) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(state: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(state).read_all().to_pandas()


def days_once(stream: DataFrame, device: str = "device_id", time: str = "ts", value: str = "value", late: str = "1 hour") -> DataFrame:
    """Rows of kind day (n, total, least, most of a device's day) and late (ts and value of a row that came too late). A row without a time has no day and is left out; null values count in n alone."""
    ship(stream.sparkSession)
    rows = stream.where(F.col(time).isNotNull()).withWatermark(time, late)
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    rows = rows.select(F.col(device).cast("string").alias("device"), F.floor(micros / (1000 * _DAY_MS)).alias("day"), micros.alias("at"), F.col(value).cast("double").alias("value"))
    return rows.withColumn("devices", F.pmod(F.xxhash64("device"), F.lit(GROUPS))).groupBy("devices", "day").transformWithStateInPandas(statefulProcessor=_Days(), outputStructType=_OUT, outputMode="append", timeMode="EventTime")


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started here keep their state in RocksDB, as timers need it; the session's own setting returns."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_days(stream: DataFrame, days: str, dead: str, checkpoint: str, **options):
    """Days and late rows of each micro-batch to two tables, in folders of the batch's number, which a repeat overwrites."""

    def step(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            df.where("kind = 'day'").select("device", "day", "n", "total", "least", "most").write.mode("overwrite").parquet(f"{days}/batch={batch_id}")
            df.where("kind = 'late'").select("device", "day", "ts", "value").write.mode("overwrite").parquet(f"{dead}/batch={batch_id}")
        finally:
            df.unpersist()

    with rocksdb(stream.sparkSession):
        return days_once(stream, **options).writeStream.foreachBatch(step).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
