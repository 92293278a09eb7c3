"""A versioned Parquet table: append, keyed merge, update, delete, expiry, compaction, history and vacuum.

A commit is a numbered JSON file under _log that lists the table's files of each touched
partition. Every operation reads the newest commit once, works from that, and commits the number
after it; the file is made under another name and then put in place only if no other is there, by a
hard link on local disks and a rename elsewhere (on stores whose rename replaces, such as some
object stores, writers need a lock of their own). So of two writers one gets Conflict and has to
work again from the newest commit, as with_retry does. Readers list the files of the newest commit.
Data go to shared storage through Spark's writers; only file names and counts pass the driver.
"""

import json
import time
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another writer has committed meanwhile."""


class Store:
    """The table at path, partitioned by columns; key names its rows."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str] = (), partition: Sequence[str] = (), max_records: int = 1_000_000):
        self.spark, self.path, self.key, self.partition, self.max_records = spark, path.rstrip("/"), list(key), list(partition), max_records
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def _versions(self) -> list[int]:
        if not self._fs.exists(self._at("_log")):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(self._at("_log")))
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and n[0].isdigit())

    def exists(self) -> bool:
        return bool(self._versions())

    def _entry(self, version: int) -> dict:
        text = self.spark.read.option("wholetext", "true").text(f"{self.path}/_log/{version:012d}.json").collect()[0][0]
        return json.loads(text)

    def _entries(self, versions: Sequence[int]) -> list[dict]:
        """Commits in order, read by one job."""
        if not versions:
            return []
        paths = [f"{self.path}/_log/{v:012d}.json" for v in versions]
        return sorted((json.loads(r[0]) for r in self.spark.read.option("wholetext", "true").text(paths).collect()), key=lambda e: e["version"])

    def numbers(self, version: int) -> dict:
        """What the commit of a version tells of its operation."""
        return self._entry(version)["numbers"]

    def version(self) -> int:
        """The newest version; -1 if there is none."""
        return max(self._versions(), default=-1)

    def _commit(self, version: int, entry: dict) -> None:
        made = self._at(f"_log/.{uuid.uuid4().hex}")
        out = self._fs.create(made)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        target = self._at(f"_log/{version:012d}.json")
        try:
            if self._fs.getUri().getScheme() == "file":  # where a rename would replace another writer's file
                local = lambda p: self.spark._jvm.java.io.File(p.toUri().getPath()).toPath()
                self.spark._jvm.java.nio.file.Files.createLink(local(target), local(made))
            elif self._fs.exists(target) or not self._fs.rename(made, target):
                raise Conflict(f"version {version} exists")
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"version {version} exists") from e
            raise
        finally:
            self._fs.delete(made, False)

    def base(self) -> dict:
        """The newest commit, from which an operation works."""
        version = self.version()
        return self._entry(version) if version >= 0 else {"version": -1, "files": [], "schema": ""}

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default."""
        entry = self._entry(self.version() if version is None else version)
        return self._of(entry["files"], entry)

    def _of(self, files: list[str], entry: dict) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], entry["schema"])
        return self.spark.read.schema(entry["schema"]).option("basePath", f"{self.path}/data").parquet(*(f"{self.path}/data/{f}" for f in files))

    def _write(self, df: DataFrame, cluster: Sequence[str] = (), drop: Sequence[str] = ()) -> list[str]:
        """Data files of df, each named from the data folder, in order of cluster; a partition value with many rows is split."""
        name = uuid.uuid4().hex
        if cluster:
            df = df.repartitionByRange(*self.partition, *cluster).sortWithinPartitions(*self.partition, *cluster)
        elif self.partition:
            df = df.hint("rebalance", *map(F.col, self.partition))
        df = df.drop(*drop)
        writer = df.write.options(compression="zstd", maxRecordsPerFile=self.max_records)
        (writer.partitionBy(*self.partition) if self.partition else writer).parquet(f"{self.path}/data/_new-{name}")
        out, files, root = [], self._fs.listFiles(self._at(f"data/_new-{name}"), True), f"data/_new-{name}/"
        while files.hasNext():
            status = files.next()
            full = status.getPath().toString()
            if full.endswith(".parquet"):
                inner = full.split(root, 1)[1]
                folder, _, base = inner.rpartition("/")
                target = f"{folder}/{name}-{base}" if folder else f"{name}-{base}"
                self._fs.mkdirs(self._at(f"data/{folder}"))
                self._fs.rename(status.getPath(), self._at(f"data/{target}"))
                out.append(target)
        self._fs.delete(self._at(f"data/_new-{name}"), True)
        return out

    def _add(self, operation: str, df: DataFrame | None, keep: list[str], base: dict, cluster: Sequence[str] = (), drop: Sequence[str] = (), **numbers) -> int:
        version, schema, files = base["version"] + 1, base["schema"], []
        if df is not None:
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.drop(*drop).schema)
            files = self._write(df, cluster, drop)
        self._commit(version, {"version": version, "operation": operation, "time": time.time(), "schema": schema, "files": sorted([*keep, *files]), "added": len(files), "numbers": numbers})
        return version

    def _fit(self, df: DataFrame, base: dict) -> DataFrame:
        """df with the table's columns first, cast to their types and null where df lacks them, and then its new ones."""
        if not base["schema"]:
            return df
        like = self.spark.createDataFrame([], base["schema"])
        known = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema]
        return df.select(*known, *(c for c in df.columns if c not in like.columns))

    def create(self, df: DataFrame) -> int:
        """The first version."""
        base = self.base()
        if base["version"] >= 0:
            raise Conflict("the table exists")
        return self._add("create", df, [], base)

    def append(self, df: DataFrame) -> int:
        """Add rows; columns that only the table or only df has are null in the others' rows."""
        base = self.base()
        return self._add("append", self._fit(df, base), base["files"], base)

    def latest(self, df: DataFrame, order: Sequence[str], counted: str | None = None) -> DataFrame:
        """One row of df for each key: the greatest by order, as one aggregate without a window; counted: a column of how many there were."""
        rest = [c for c in df.columns if c not in self.key]
        best = F.max_by(F.struct(*rest), F.struct(*order)) if rest else F.lit(None)
        made = df.groupBy(*self.key).agg(best.alias("_r"), F.count("*").alias("_n"))
        return made.select(*(F.col(c) if c in self.key else F.col(f"_r.{c}").alias(c) for c in df.columns), *([F.col("_n").alias(counted)] if counted else []))

    def _touched(self, source: DataFrame, base: dict) -> list[str]:
        """Files of the partitions that source has rows of; all files of a table without partitions."""
        if not self.partition:
            return base["files"]
        values = source.select(*(F.col(c).cast("string").alias(c) for c in self.partition)).distinct().collect()  # one row a touched partition
        keys = {"/".join(f"{c}={self._name(r[c])}" for c in self.partition) for r in values}
        return [f for f in base["files"] if f.rpartition("/")[0] in keys]

    def _name(self, value: str | None) -> str:
        if value is None or value == "":
            return "__HIVE_DEFAULT_PARTITION__"
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)

    def merge(self, source: DataFrame, order: Sequence[str], update: bool = True, newer_only: str | None = None) -> int:
        """Upsert the latest row of each key of source; touched partitions alone are rewritten.

        Where the key has all partition columns a matched row lies in the partition of its source row.
        Else the keys are looked for in all partitions, by a scan of key and partition columns only, and
        a row whose partition has changed moves there. The table has one row a key either way.
        update: matched rows are replaced (columns that source lacks keep their values), else they stay.
        newer_only: a column by which a matched row is replaced only if the new value is not less.
        The commit's numbers have the source's rows (one a key), how many were matched and inserted, and the ratios.
        """
        base = self.base()
        given, source = source, self.latest(source, order, "_rows").persist()  # counted, matched and written
        try:
            n, rows_in = source.agg(F.count("*"), F.coalesce(F.sum("_rows"), F.lit(0))).collect()[0]
            source = source.drop("_rows")
            if base["version"] < 0:
                return self._add("create", source, [], base, rows_in=rows_in, source_rows=n, matched=0, inserted=n, match_ratio=0.0, insert_ratio=1.0 if n else 0.0)
            return self._merged(base, given, source, update, newer_only, n, rows_in)
        finally:
            source.unpersist()

    def _merged(self, base: dict, given: DataFrame, source: DataFrame, update: bool, newer_only: str | None, n: int, rows_in: int) -> int:
        touched = self._touched(given, base) if set(self.partition) <= set(given.columns) else []  # of the rows as given: no key needs to be shuffled to see their partitions
        if not set(self.partition) <= set(self.key):
            known = self._of(base["files"], base).select(*dict.fromkeys([*self.key, *self.partition]))
            touched = sorted({*touched, *self._touched(known.join(source.select(*self.key), self.key, "left_semi"), base)})
        target = self._of(touched, base)
        matched = source.join(target.select(*self.key), self.key, "left_semi").count()
        numbers = {"rows_in": rows_in, "source_rows": n, "matched": matched, "inserted": n - matched, "match_ratio": matched / n if n else 0.0, "insert_ratio": (n - matched) / n if n else 0.0}
        if not update:
            fresh = source.join(target.select(*self.key), self.key, "left_anti")
            return self._add("insert", self._fit(fresh, base), base["files"], base, **numbers)
        if lacking := [c for c in target.columns if c not in source.columns]:
            source = source.join(target.select(*self.key, *lacking), self.key, "left")
        source = self._fit(source, base)
        if newer_only:
            both = target.withColumn("_new", F.lit(0)).unionByName(source.withColumn("_new", F.lit(1)), allowMissingColumns=True)
            merged = self.latest(both, [newer_only, "_new"]).drop("_new")
        else:
            merged = target.join(source.select(*self.key), self.key, "left_anti").unionByName(source, allowMissingColumns=True)
        keep = set(base["files"]) - set(touched)
        return self._add("merge", merged, sorted(keep), base, **numbers)

    def _rewrite(self, operation: str, condition: Column, change: Callable[[DataFrame], DataFrame]) -> int:
        """Write the partitions that have rows of the condition again, changed."""
        base = self.base()
        found = self._of(base["files"], base).where(condition)
        touched = self._touched(found, base)
        n = found.count()
        if not n:
            return base["version"]
        made = change(self._of(touched, base))
        return self._add(operation, made, sorted(set(base["files"]) - set(touched)), base, rows=n)

    def update(self, condition: Column, values: dict[str, Column]) -> int:
        """Set columns where the condition holds."""
        return self._rewrite("update", condition, lambda df: df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()}))

    def delete(self, condition: Column) -> int:
        """Remove the rows for which the condition holds; those for which it is null stay."""
        return self._rewrite("delete", condition, lambda df: df.where(~F.coalesce(condition, F.lit(False))))

    def expire(self, partition: str, before: str) -> int:
        """Drop whole partitions whose value, as text, is less than before; no data are read."""
        base = self.base()
        value = lambda f: next((x.partition("=")[2] for x in f.split("/") if x.startswith(f"{partition}=")), None)
        gone = [f for f in base["files"] if (v := value(f)) is not None and v != "__HIVE_DEFAULT_PARTITION__" and v < before]
        return self._add("expire", None, sorted(set(base["files"]) - set(gone)), base, files=len(gone)) if gone else base["version"]

    def optimize(self, *cluster: str, least_files: int = 2) -> int:
        """Rewrite partitions of at least so many files in fewer, or with cluster columns all of them in their order."""
        base, folders = self.base(), {}
        for f in base["files"]:
            folders.setdefault(f.rpartition("/")[0], []).append(f)
        files = [f for own in folders.values() if cluster or len(own) >= least_files for f in own]
        if not files:
            return base["version"]
        return self._add("optimize", self._of(files, base), sorted(set(base["files"]) - set(files)), base, cluster)

    def zorder(self, *columns: str, bits: int = 8) -> int:
        """Rewrite clustered by interleaved bits of the columns' quantile ranks."""
        base = self.base()
        df = self._of(base["files"], base)
        return self._add("zorder", df.withColumn("_z", z_value(df, columns, bits)), [], base, ["_z"], ["_z"])

    def vacuum(self, keep_hours: float = 336.0) -> int:
        """Delete data files that no version younger than so many hours has, nor the newest, and that are as old themselves; returns how many.

        Files of failed commits go too. A writer that takes longer than keep_hours would lose its files.
        """
        versions = self._entries(self._versions())
        oldest = time.time() - keep_hours * 3600
        live = {f for e in versions if e["time"] >= oldest or e is versions[-1] for f in e["files"]}
        files, gone, root = self._fs.listFiles(self._at("data"), True), 0, self._fs.makeQualified(self._at("data")).toUri().getPath() + "/"
        while files.hasNext():
            status = files.next()
            name = status.getPath().toUri().getPath().removeprefix(root)
            if name.endswith(".parquet") and name not in live and status.getModificationTime() / 1000 <= oldest + (1 if not keep_hours else 0):
                self._fs.delete(status.getPath(), False)
                gone += 1
        return gone

    def history(self, n: int = 20) -> DataFrame:
        """The newest n commits."""
        rows = [(e["version"], e["operation"], e["time"], len(e["files"]), e["added"]) for e in self._entries(self._versions()[-n:])]
        return self.spark.createDataFrame(rows[::-1], "version bigint, operation string, time double, n_files bigint, n_added bigint")

    def detail(self) -> dict:
        entry = self._entry(self.version())
        size = sum(self._fs.getFileStatus(self._at(f"data/{f}")).getLen() for f in entry["files"])
        return {"version": entry["version"], "files": len(entry["files"]), "bytes": size, "partition": self.partition}


def process(store: Store, df: DataFrame, order: Sequence[str], optimize: bool = True, vacuum: bool = True) -> dict:
    """Merge a frame into a table, maintain it, and tell what was done: rows in and in the table, matches, seconds."""
    began = time.time()
    version = with_retry(lambda: store.merge(df, order))
    numbers = store.numbers(version)
    if optimize:
        store.optimize()
    removed = store.vacuum() if vacuum else 0
    return {"version": version, "rows_after": store.read().count(), "files_removed": removed, "seconds": time.time() - began} | numbers


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 8):
    """Interleaved bits of each column's place among its approximate quantiles."""
    steps = (1 << bits) - 1
    codes = []
    for c in columns:
        code = F.xxhash64(c) if df.schema[c].dataType.simpleString() == "string" else F.col(c).cast("double")
        cuts = df.select(F.percentile_approx(code, [i / steps for i in range(1, steps)], 1000)).collect()[0][0] or []
        codes.append(_count_up_to(sorted(set(cuts)), code))
    out = F.lit(0).cast("long")
    for b in range(bits):
        for i, code in enumerate(codes):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(code, b).bitwiseAND(F.lit(1)).cast("long"), b * len(codes) + i))
    return out


def _count_up_to(cuts: list, code: Column) -> Column:
    """How many of the cuts are not above code."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x <= code)) if cuts else F.lit(0)


def with_retry(step, tries: int = 3, wait: float = 1.0, transient=("FileNotFoundException", "does not exist")):
    """Call step again after 1, 2, 4... waits if it fails by a missing file or another writer's commit; else raise at once."""
    for attempt in range(tries):
        try:
            return step()
        except Exception as e:
            if attempt + 1 == tries or not (isinstance(e, Conflict) or any(t in str(e) for t in transient)):
                raise
            time.sleep(wait * 2**attempt)
