"""A record log of topics and partitions in a shared folder, as a Spark data source that streams from and to it.

A segment is a file of JSON lines, <topic>/<partition>/<first offset>-<records>.json, with a key, a
value and a time in each line; it never changes. The reader keeps offsets of its own: the next one of
each partition. A trigger takes at most so many records, dealt over the partitions, and each range of
offsets is read by tasks, so a batch that failed is read again with the same records. What waits at a
start may be taken in so many triggers at most instead, as a trigger has a cost of its own and a long log
would have too many of them. The driver lists the segments, once a trigger, and a range has the names of
its own. The folder must be one that the driver's and the tasks' Python can open (a mounted share on a
cluster).

The writer has two phases. Tasks stage files of batches of rows under a name of their own; when all tasks are
done the driver gives the batch's records their offsets and puts the files in place. A batch number that was
committed before is dropped, and what failed tasks or batches staged is removed, so a task or a batch that
runs twice leaves its records once. A batch of rows that cannot be encoded is tried row by row, and the
rows that cannot go to the topic's dead letters.
"""

import ast
import base64
import json
import os
import shutil
import time
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceStreamWriter, InputPartition, WriterCommitMessage

from ..session import ship

SCHEMA = "topic string, partition int, offset long, key string, value string, timestamp timestamp"
#: Rows that a task encodes and stages together.
BATCH = 10_000
#: Records that a task reads at most.
READ = 100_000


def _folder(path: str) -> Path:
    return Path(path.removeprefix("file://"))


def listed(path: str, topic: str) -> dict[int, list[tuple[int, int]]]:
    """(first offset, records) of the segments of each partition, in order."""
    root, out = _folder(path) / topic, {}
    for partition in root.iterdir() if root.is_dir() else ():
        if partition.name.isdigit():
            out[int(partition.name)] = sorted(tuple(map(int, f.stem.split("-"))) for f in partition.glob("*.json"))
    return out


def ends(path: str, topic: str) -> dict[int, int]:
    """The next offset of each partition."""
    return {p: own[-1][0] + own[-1][1] if own else 0 for p, own in listed(path, topic).items()}


def dead(path: str, topic: str) -> list[str]:
    """Names of the files of dead letters."""
    folder = _folder(path) / topic / "_dead"
    return sorted(f.name for f in folder.iterdir()) if folder.is_dir() else []


class Range(InputPartition):
    """Records of a partition from one offset up to another, and the segments that hold them."""

    def __init__(self, topic: str, partition: int, first: int, last: int, segments: list[tuple[int, int]]):
        self.topic, self.partition, self.first, self.last, self.segments = topic, partition, first, last, segments


class Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.topics = options["path"], options["topics"].split(",")
        self.limit, self.tasks = int(options.get("maxoffsetspertrigger", 3000)), int(options.get("minpartitions", 12))
        self.latest, self.checkpoint, self.backlog = options.get("startingoffsets", "latest") == "latest", options.get("checkpoint"), int(options.get("backlogtriggers", 0))
        self.at: dict | None = None

    def _ends(self) -> dict:
        return {t: {str(p): n for p, n in ends(self.path, t).items()} for t in self.topics}

    def initialOffset(self) -> dict:
        self.at = self._ends() if self.latest else {t: dict.fromkeys(own, 0) for t, own in self._ends().items()}
        return self.at

    def _resumed(self) -> dict:
        """After a restart: the newest offsets that the query has planned, from its own log."""
        log = _folder(self.checkpoint) / "offsets" if self.checkpoint else None
        numbers = sorted(int(f.name) for f in log.iterdir() if f.name.isdigit()) if log and log.is_dir() else []
        return json.loads((log / str(numbers[-1])).read_text().split("\n")[2]) if numbers else self.initialOffset()

    def latestOffset(self) -> dict:
        """At most the limit's number of records more than before, in even shares that partitions with fewer leave to the others."""
        there, begins = self._ends(), self.at is None
        if begins:
            self.at = self._resumed()
        now = {t: dict(self.at.get(t, {})) for t in self.topics}
        open_ = sorted((n - now[t].get(p, 0), t, p) for t, own in there.items() for p, n in own.items())
        if begins and self.backlog:
            self.limit = max(self.limit, -(-sum(max(0, n) for n, _, _ in open_) // self.backlog))
        left = self.limit
        for i, (waiting, t, p) in enumerate(open_):
            take = min(max(0, waiting), left // (len(open_) - i))
            now[t][p], left = now[t].get(p, 0) + take, left - take
        self.at = now
        return now

    def partitions(self, start: dict, end: dict) -> list[Range]:
        whole = [(t, int(p), start.get(t, {}).get(p, 0), n) for t, own in end.items() for p, n in own.items()]
        total = sum(b - a for _, _, a, b in whole)
        size, there = min(READ, max(1, -(-total // self.tasks))), {t: listed(self.path, t) for t in end}

        def held(own: list[tuple[int, int]], lo: int, hi: int) -> list[tuple[int, int]]:
            return own[max(0, bisect_right(own, lo, key=lambda x: x[0]) - 1) : bisect_left(own, hi, key=lambda x: x[0])]

        return [Range(t, p, lo, hi, held(there[t].get(p, []), lo, hi)) for t, p, a, b in whole for lo in range(a, b, size) for hi in (min(lo + size, b),)]

    def read(self, partition: Range) -> Iterator[tuple]:
        folder = _folder(self.path) / partition.topic / str(partition.partition)
        for first, n in partition.segments:
            with (folder / f"{first:020d}-{n}.json").open() as lines:
                for offset, line in enumerate(lines, first):
                    if partition.first <= offset < partition.last:
                        r = json.loads(line)
                        yield partition.topic, partition.partition, offset, r["key"], r["value"], datetime.fromtimestamp(r["at"] / 1e6, UTC)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class Staged(WriterCommitMessage):
    """A task's folder, and how many records it has for each partition in each of its files."""

    def __init__(self, folder: str, files: list[tuple[int, str, int]], dead: str | None):
        self.folder, self.files, self.dead = folder, files, dead


def _line(row) -> str:
    """A row as a JSON line; a value that is no text raises."""
    key, value, at = row["key"], row["value"], row["timestamp"]
    if isinstance(value, (bytes, bytearray)):
        value = bytes(value).decode()  # strict: what is not UTF-8 raises
    if value is None:
        raise ValueError("a record without a value")
    return json.dumps({"key": key, "value": value, "at": int(at.timestamp() * 1e6) if at else 0})


class Writer(DataSourceStreamWriter):
    def __init__(self, options: dict):
        self.path, self.topic, self.parts = options["path"], options["topic"], int(options.get("partitions", 12))
        self.name, self.batch = options.get("writer", "writer"), int(options.get("batch", BATCH))

    @property
    def root(self) -> Path:
        return _folder(self.path) / self.topic

    def _part(self, row) -> int:
        own = row["partition"] if "partition" in row else None
        return own if own is not None else zlib.crc32((row["key"] or "").encode()) % self.parts

    def write(self, iterator) -> Staged:
        from pyspark import TaskContext

        context = TaskContext.get()
        folder = self.root / "_staged" / f"{self.name}-{context.partitionId() if context else 0}-{uuid.uuid4().hex}"
        folder.mkdir(parents=True)
        files, dead, held, open_ = [], [], [], {}

        def put(p: int, lines: list[str]) -> None:
            name = f"{len(files):08d}.json"
            (folder / name).write_text("\n".join(lines) + "\n")
            files.append((p, name, len(lines)))

        def stage(rows):
            try:
                lines = [(self._part(r), _line(r)) for r in rows]
            except (ValueError, AttributeError, TypeError):
                lines = []
                for r in rows:  # the batch as a list of rows, so that one bad row costs itself alone
                    try:
                        lines.append((self._part(r), _line(r)))
                    except (ValueError, AttributeError, TypeError) as e:
                        value = r["value"]
                        dead.append(json.dumps({"key": r["key"], "value": base64.b64encode(bytes(value)).decode() if isinstance(value, (bytes, bytearray)) else value, "error": str(e)}))
            for p, line in lines:  # a partition's file is full with a batch's number of records, whatever batches they came in
                own = open_.setdefault(p, [])
                own.append(line)
                if len(own) == self.batch:
                    put(p, open_.pop(p))

        for row in iterator:
            held.append(row.asDict())
            if len(held) == self.batch:
                stage(held)
                held = []
        if held:
            stage(held)
        for p, own in sorted(open_.items()):
            put(p, own)
        if dead:
            (folder / "dead").write_text("\n".join(dead) + "\n")
        return Staged(str(folder), files, "dead" if dead else None)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        """Offsets in order of task and file; a marker, written last, tells that the batch is in. Files put in place by a commit that broke off are found by its plan."""
        marks = self.root / "_batches" / self.name
        marks.mkdir(parents=True, exist_ok=True)
        done, plan = marks / f"{batchId}.done", marks / f"{batchId}.plan"
        if not done.exists():
            # a plan that broke off is finished first: its staged files may be there still
            if plan.exists():
                moves = json.loads(plan.read_text())
            else:
                last, moves = ends(self.path, self.topic), []
                for m in sorted((m for m in messages if m), key=lambda m: m.folder):
                    for p, name, n in m.files:
                        at = last.get(p, 0)
                        moves.append([f"{m.folder}/{name}", str(self.root / str(p) / f"{at:020d}-{n}.json")])
                        last[p] = at + n
                    if m.dead:
                        moves.append([f"{m.folder}/{m.dead}", str(self.root / "_dead" / f"{self.name}-{batchId}-{Path(m.folder).name}.json")])
                written = plan.with_suffix(f".{uuid.uuid4().hex}")
                written.write_text(json.dumps(moves))
                written.rename(plan)
            for source, target in moves:
                Path(target).parent.mkdir(parents=True, exist_ok=True)
                if not os.path.exists(target):
                    os.replace(source, target)  # raises if it is nowhere
            done.touch()
        self._clear(messages)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        """What was staged goes, but for files of a commit that has a plan and is to be finished."""
        if not (self.root / "_batches" / self.name / f"{batchId}.plan").exists():
            self._clear(messages)

    def _clear(self, messages) -> None:
        """What this batch's tasks have staged goes, and what tasks that were lost left of it; a query has one batch at a time."""
        for m in messages:
            if m:
                shutil.rmtree(m.folder, ignore_errors=True)
        for left in (self.root / "_staged").glob(f"{self.name}-*"):
            shutil.rmtree(left, ignore_errors=True)


class Segments(DataSource):
    """format("segments"): options path, topics, startingOffsets, maxOffsetsPerTrigger, backlogTriggers, minPartitions and checkpoint to read; path, topic, partitions, writer and batch to write."""

    @classmethod
    def name(cls) -> str:
        return "segments"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> Reader:
        return Reader({k.lower(): v for k, v in self.options.items()})

    def streamWriter(self, schema, overwrite: bool) -> Writer:
        return Writer({k.lower(): v for k, v in self.options.items()})


def stream(spark: SparkSession, path: str, *topics: str, checkpoint: str, per_trigger: int = 3000, partitions: int = 12, starting: str = "latest", backlog: int = 0) -> DataFrame:
    """A stream of the topics' records; checkpoint is the folder of the query that reads it, by which a restart knows where it was.

    backlog: what waits at a start is taken in so many triggers at most, of more than per_trigger records if need be; 0: per_trigger always holds.
    """
    ship(spark)
    spark.dataSource.register(Segments)
    options = {"path": path, "topics": ",".join(topics), "checkpoint": checkpoint, "maxOffsetsPerTrigger": str(per_trigger), "minPartitions": str(partitions), "startingOffsets": starting, "backlogTriggers": str(backlog)}
    return spark.readStream.format("segments").options(**options).load()


def write(stream_: DataFrame, path: str, topic: str, checkpoint: str, partitions: int = 12, batch: int = BATCH, writer: str = "writer"):
    """A stream (key string, value string or binary, timestamp, and partition if it is given) to a topic; a key has one partition."""
    ship(stream_.sparkSession)
    stream_.sparkSession.dataSource.register(Segments)
    options = {"path": path, "topic": topic, "partitions": str(partitions), "writer": writer, "batch": str(batch), "checkpointLocation": checkpoint}
    return stream_.writeStream.format("segments").options(**options).trigger(availableNow=True).start()


def drained(query, path: str, *topics: str) -> None:
    """Wait until a stream with a processing-time trigger has read what the topics have now, then stop it; its failure raises."""
    want = {t: {str(p): n for p, n in ends(path, t).items()} for t in topics}
    try:
        while True:
            query.processAllAvailable()  # what the last look at the topics offered, a trigger's worth at least
            seen = query.lastProgress["sources"][0]["endOffset"] if query.lastProgress else None
            now = ast.literal_eval(seen) if isinstance(seen, str) else seen or {}
            if all(now.get(t, {}).get(p, 0) >= n for t, own in want.items() for p, n in own.items()):
                return
            time.sleep(0.05)
    finally:
        query.stop()
