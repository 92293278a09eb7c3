"""Shared folders for tables that a job writes and reads again, and helpers used by every operator here."""

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables of at most so many bytes, as measured, may be broadcast.
BROADCAST_BYTES = 24 << 20


#: Rows of whole documents that go to a Python worker at a time: some MB, where Spark's default makes it ten times that.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, besides what the cluster's own path holds; batches are bounded."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def base(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, a temporary one that is kept for the session, on a local master only."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lakegauge-"))
    return context.getCheckpointDir().rstrip("/")


class Workspace:
    """A folder of its own for one call of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        prepare(spark)
        self.spark, self.path = spark, f"{base(spark)}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, codec: str = "zstd", **options) -> DataFrame:
        """Write df as Parquet and read it back: this cuts the lineage and survives lost executors."""
        df.write.mode("overwrite").options(compression=codec, **options).parquet(f"{self.path}/{name}")
        return self.read(name, df.schema)

    def read(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        """Remove tables that no later step reads."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df, marked for broadcast if its rows, measured with their texts and arrays, take at most so many bytes; left to Spark's own choice beyond."""
    size = F.lit(16)
    for f in df.schema:
        kind = f.dataType.typeName()
        size = size + (F.coalesce(F.octet_length(f.name), F.lit(0)) if kind in ("string", "binary") else F.coalesce(F.octet_length(F.to_json(f.name)), F.lit(0)) if kind in ("array", "map", "struct") else F.lit(16))
    measured = df.agg(F.sum(size.cast("long"))).collect()[0][0] or 0
    return F.broadcast(df) if measured <= limit else df


def without(docs: DataFrame, *made: str) -> DataFrame:
    """docs without columns that have the name of one that an operator makes; the operator's column takes its place."""
    names = {m.lower() for m in made}
    return docs.drop(*(c for c in docs.columns if c.lower() in names))


def ddl(df: DataFrame) -> str:
    """The columns of df as a schema string."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)
