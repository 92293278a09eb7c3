"""The most frequent keys, exactly, without shuffling all keys where a few stand out.

Every task keeps a summary of at most COUNTERS keys' hashes (Misra and Gries 1982; merging as by
Agarwal and others 2012): a count that is too small by at most the task's error. Summed by hash, a key
has at least its sum and at most its sum and all tasks' errors; a key in no summary has at most the
errors. If the n-th largest sum is above the errors, no key outside the summaries can be among the
first n, and those whose most could be are counted exactly. Else all keys are counted.
"""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship

COUNTERS = 4096


class Summary:
    """Counts of at most `size` keys, each too small by at most `error`."""

    def __init__(self, size: int = COUNTERS):
        self.size, self.error = size, 0
        self.key, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, n: np.ndarray | None = None, error: int = 0) -> "Summary":
        """Keys (n times each, once by default), or another summary with its error."""
        both = np.concatenate([self.key, keys])
        weight = np.concatenate([self.n, np.ones(len(keys), np.int64) if n is None else n])
        self.key, at = np.unique(both, return_inverse=True)
        self.n = np.bincount(at, weight, len(self.key)).astype(np.int64)
        self.error += error
        if len(self.key) > self.size:
            less = int(np.partition(self.n, len(self.n) - self.size - 1)[len(self.n) - self.size - 1])  # the largest that has no counter
            keep = self.n > less
            self.key, self.n, self.error = self.key[keep], self.n[keep] - less, self.error + less
        return self


def summaries(df: DataFrame, hash_: str, counters: int = COUNTERS) -> DataFrame:
    """(hash, n, error) rows of each task's summary; the error is in a row without a hash."""
    ship(df.sparkSession)

    def run(batches):
        own = Summary(counters)
        for batch in batches:
            own.add(batch.column(0).to_numpy())
        n = len(own.key)
        yield pa.RecordBatch.from_arrays([pa.array([*own.key.tolist(), None], pa.int64()), pa.array([*own.n.tolist(), 0]), pa.array([0] * n + [own.error])], ["hash", "n", "error"])

    return df.select(hash_).mapInArrow(run, "hash long, n long, error long")


def top_keys(df: DataFrame, key: Sequence[str], n: int, least: int = 1, counters: int = COUNTERS) -> DataFrame:
    """key and n_rows of the n most frequent keys with at least so many rows, in that order; ties by the key."""
    hashed = df.select(*key, F.xxhash64(*key).alias("_hash"))
    found = summaries(hashed, "_hash", counters).groupBy("hash").agg(F.sum("n").alias("n"), F.sum("error").alias("error"))
    first = found.orderBy(F.col("hash").isNull().desc(), F.desc("n")).limit(n + 1).collect()  # the errors and the n largest sums
    error = first[0]["error"] if first and first[0]["hash"] is None else 0
    sums = [r["n"] for r in first if r["hash"] is not None]
    bar = max(least, sums[n - 1] if len(sums) >= n else 0)
    if error < bar:  # no key outside the summaries has so many
        likely = found.where(F.col("hash").isNotNull() & (F.col("n") + error >= bar)).select(F.col("hash").alias("_hash"))
        # their number is bounded by counters, for all of them together have no more rows than the table
        hashed = hashed.join(F.broadcast(likely) if likely.count() <= 16 * counters else likely, "_hash", "left_semi")
    return hashed.groupBy(*key).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") >= least).orderBy(F.desc("n_rows"), *key).limit(n)
