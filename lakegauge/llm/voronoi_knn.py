"""Exact top-k search by inner product, as a join of queries and vectors over Voronoi cells.

Vectors become whole numbers first: floor(scale * x) of every component. Pivots, of a bounded sample,
divide the space; every query and every row belongs to its nearest pivot. The summary of a query cell
is its radius U, the largest distance of its queries from the pivot p. As q.x = p.x + (q - p).x, a row x
scores between p.x - U|x| and p.x + U|x| with any query of the cell. A pass over all rows keeps of
each task the k + 1 largest lower bounds for each cell; the least of the best k + 1 of them all (one may
be the query's own row) is a score that k rows reach for every query of the cell. Only rows whose
upper bound gets there are copied to the cell's group, and whole cells of rows are left out by
their own summaries: largest norm and largest distance from the pivot.

Cells are packed into groups of at most GROUP_QUERIES queries, and a cell of more is split; the rows
copied to a group are dealt over slices. So a task holds one group's queries, and passes the rows of a
slice in blocks by matrix products; the best of the slices meet by query. Where vectors have no structure
(as random ones of many dimensions) the bounds exclude little, and every group gets nearly all rows;
the groups are large for that reason.

Defined results: rows whose vec_id or vector is null, or whose vector holds null or a number that is not
finite, take no part; shorter vectors are as if filled up with zeros, so an empty one scores 0; rows with
a query's own vec_id are not its candidates, and other rows that repeat count each; a query that repeats is
answered each time; ties go to the smaller vec_id; with fewer candidates than k all are returned; a
score that does not fit 64 bits is an error; other columns are not used.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace, partitions, prepare

#: Rows that choose the pivots, and pivots at most.
SAMPLE, PIVOTS = 4096, 256
GROUP_QUERIES, SLICE_ROWS = 1 << 15, 1 << 18
#: Rows of a block, and scores that are computed at a time.
BLOCK_ROWS, SCORES = 4096, 1 << 22
NONE = np.iinfo(np.int64).min


def matrix(column, width: int) -> np.ndarray:
    """The rows of a column of vectors, each as many little-endian 64-bit integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column) or not width:
        return np.zeros((len(column), width), np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].copy().view("<i8").reshape(len(column), width)


def whole(vectors: DataFrame, scale: float, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """(vec_id, vector) of the rows that take part, with vectors as bytes of whole numbers of one width, and that width."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.where(~F.exists("vector", bad))
    width = rows.agg(F.max(F.size("vector"))).collect()[0][0] or 0

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            size = np.diff(lists.offsets.to_numpy())
            if len(size) == 0:
                continue
            found = np.floor(scale * lists.flatten().to_numpy())
            if np.abs(found).max(initial=0) >= 2.0**62:
                raise OverflowError("a component does not fit 64 bits")
            full = np.zeros((len(size), width), "<i8")
            full[np.arange(width) < size[:, None]] = found.astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in full], pa.binary())], ["vec_id", "vector"])

    return rows.mapInArrow(run, "vec_id long, vector binary"), width


def choose_pivots(sample: np.ndarray, n: int, rounds: int = 6) -> np.ndarray:
    """Centres of a sample: rows far from each other to begin with, then a few rounds of means."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    sample = sample.astype(np.float64)
    chosen, far = [0], ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    pivots = sample[chosen]
    for _ in range(rounds):
        cell = nearest(sample, pivots)[0]
        size = np.bincount(cell, minlength=len(pivots))
        sums = np.zeros_like(pivots)
        np.add.at(sums, cell, sample)
        pivots = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], pivots)
    return pivots


def nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's pivot and its distance from that."""
    rows = rows.astype(np.float64)
    cell = ((pivots**2).sum(axis=1) - 2 * (rows @ pivots.T)).argmin(axis=1)
    return cell, np.sqrt(((rows - pivots[cell]) ** 2).sum(axis=1))


def _slack(pivots: np.ndarray, radius: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """More than rounding can change in a bound."""
    return 1e-9 * np.multiply.outer(np.sqrt((pivots**2).sum(axis=1)) + radius, norm) + 1e-3


class Bounds:
    """pivots; radius of the queries of each cell, -1 without any; reach: largest norm and distance of each cell's rows; least: the score that matters, by query cell."""

    def __init__(self, pivots: np.ndarray, radius: np.ndarray, reach: np.ndarray):
        self.pivots, self.radius, self.reach = pivots, radius, reach
        self.cells = np.flatnonzero(radius >= 0)
        self.least = np.full(len(pivots), -np.inf)

    def range(self, rows: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and most that each row can score with queries of the cells."""
        rows = rows.astype(np.float64)
        norm = np.sqrt((rows**2).sum(axis=1))
        middle = self.pivots[cells] @ rows.T
        spread = np.multiply.outer(self.radius[cells], norm) + _slack(self.pivots[cells], self.radius[cells], norm)
        return middle - spread, middle + spread

    def settle(self) -> None:
        """Which query cells a cell of rows can matter to at all."""
        norm, far = self.reach
        middle = self.pivots @ self.pivots.T
        most = middle + np.multiply.outer(np.sqrt((self.pivots**2).sum(axis=1)), far) + np.multiply.outer(np.maximum(self.radius, 0), norm) + _slack(self.pivots, np.maximum(self.radius, 0), norm + far)
        self.open = (most >= self.least[:, None]) & (self.radius >= 0)[:, None]


def _placed(rows: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """rows (vec_id, vector) with the cell, the distance from its pivot and the norm."""

    def run(batches):
        for batch in batches:
            found = matrix(batch.column(1), width)
            cell, far = nearest(found, pivots)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far), pa.array(np.sqrt((found.astype(np.float64) ** 2).sum(axis=1)))], ["vec_id", "vector", "cell", "far", "norm"])

    return rows.mapInArrow(run, "vec_id long, vector binary, cell int, far double, norm double")


def _best_bounds(rows: DataFrame, bounds: Bounds, width: int, k: int) -> dict[int, float]:
    """The k-th largest lower bound but one of each query cell; a task passes on k + 1 numbers for each cell."""
    cells = bounds.cells

    def run(batches):
        best = np.full((len(cells), 0), 0.0)
        for batch in batches:
            low = bounds.range(matrix(batch.column(0), width), cells)[0]
            best = np.concatenate([best, low], axis=1)
            if best.shape[1] > k + 1:
                best = np.partition(best, best.shape[1] - k - 1, axis=1)[:, -k - 1 :]
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array([x.tolist() for x in best], pa.list_(pa.float64()))], ["cell", "low"])

    found = rows.select("vector").mapInArrow(run, "cell int, low array<double>")
    best = found.groupBy("cell").agg(F.slice(F.sort_array(F.flatten(F.collect_list("low")), False), 1, k + 1).alias("low"))  # k + 1 numbers for each task
    return {r["cell"]: r["low"][k] if len(r["low"]) > k else -np.inf for r in best.collect()}


def _groups(pivots: np.ndarray, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of each cell: neighbouring cells share a group, a large cell has several."""
    spread = pivots - pivots.mean(axis=0)
    order = np.argsort(spread @ np.linalg.svd(spread, full_matrices=False)[2][0]) if pivots.size else np.arange(len(pivots))
    first, parts, group, size = np.zeros(len(pivots), np.int64), np.ones(len(pivots), np.int64), 0, 0
    for c in order:
        n = int(queries[c])
        if size and size + n > limit:
            group, size = group + 1, 0
        first[c], parts[c] = group, max(1, -(-n // limit))
        size += n
        if parts[c] > 1:
            group, size = group + int(parts[c]), 0
    return first, parts


class Best:
    """The best k rows so far of each query."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int):
        self.ids, self.rows, self.k = ids, rows, k
        self.score, self.who = np.full((len(ids), k), NONE), np.zeros((len(ids), k), np.int64)
        self.order = np.argsort(ids, kind="stable")

    def scores(self, lo: int, hi: int, rows: np.ndarray) -> np.ndarray:
        bound = int(np.abs(self.rows[lo:hi]).max(initial=0)) * int(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
        if bound < 2**53:
            return (self.rows[lo:hi].astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
        if bound < 2**63:
            return self.rows[lo:hi] @ rows.T
        raise OverflowError("a score may not fit 64 bits")

    def see(self, cell: slice, ids: np.ndarray, rows: np.ndarray) -> None:
        """Rows that may matter to the queries of a cell, which lie side by side."""
        k, step = self.k, max(1, SCORES // max(1, len(ids)))
        for lo in range(cell.start, cell.stop, step):
            hi = min(cell.stop, lo + step)
            found = self.scores(lo, hi, rows)
            by_id = np.argsort(self.ids[lo:hi], kind="stable")
            sorted_ids = self.ids[lo:hi][by_id]
            first, last = np.searchsorted(sorted_ids, ids, "left"), np.searchsorted(sorted_ids, ids, "right")
            for j in np.flatnonzero(last > first):
                found[by_id[first[j] : last[j]], j] = NONE
            least = np.maximum(self.score[lo:hi, -1], np.partition(found, found.shape[1] - k, axis=1)[:, -k] if found.shape[1] >= k else NONE)
            q, at = np.nonzero((found >= least[:, None]) & (found > NONE))
            score, who = found[q, at], ids[at]
            touched = np.unique(q)
            q = np.concatenate([q, np.repeat(touched, k)])
            score, who = np.concatenate([score, self.score[lo + touched].ravel()]), np.concatenate([who, self.who[lo + touched].ravel()])
            order = np.lexsort((who, -(score + (score == NONE)), q))
            q, score, who = q[order], score[order], who[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            keep = place < k
            self.score[lo + q[keep], place[keep]], self.who[lo + q[keep], place[keep]] = score[keep], who[keep]


def _solved(met: DataFrame, bounds: Bounds, width: int, k: int) -> DataFrame:
    """The best k of each group's slice, by query row."""

    def run(batches):
        def finish(held, best, row):
            if best is None:
                return
            q, at = np.nonzero(best.score > NONE)
            for lo in range(0, len(q), 10_000):
                part = slice(lo, lo + 10_000)
                yield pa.RecordBatch.from_arrays([pa.array(row[q[part]]), pa.array(best.ids[q[part]]), pa.array(best.who[q[part], at[part]]), pa.array(best.score[q[part], at[part]])], ["row", "query_id", "vec_id", "score"])

        key, asked, best, row, cells, held, size = None, [], None, None, [], [], 0

        def begin():
            """The queries of a group, by cell."""
            rows = np.concatenate([matrix(b.column(5), width) for b in asked])
            cell, number, ids = (np.concatenate([b.column(i).to_numpy() for b in asked]) for i in (2, 3, 4))
            order = np.argsort(cell, kind="stable")
            edges = np.flatnonzero(np.diff(cell[order], prepend=-1, append=-1))
            return Best(ids[order], rows[order], k), number[order], [(int(cell[order][a]), slice(int(a), int(b))) for a, b in zip(edges, edges[1:])]

        def solve():
            ids, rows = np.concatenate([b.column(4).to_numpy() for b in held]), np.concatenate([matrix(b.column(5), width) for b in held])
            most = bounds.range(rows, np.array([c for c, _ in cells]))[1]
            for (c, span), reach in zip(cells, most):
                matter = reach >= max(bounds.least[c], float(best.score[span, -1].min()))
                if matter.any():
                    best.see(span, ids[matter], rows[matter])

        for batch in batches:
            keys = batch.column(0).to_numpy()
            for lo, hi in zip(*(lambda e: (e[:-1], e[1:]))(np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]]))):
                if hi == lo:
                    continue
                part = batch.slice(lo, hi - lo)
                if keys[lo] != key:
                    if held and best is not None:
                        solve()
                    yield from finish(held, best, row)
                    key, asked, best, held, size = keys[lo], [], None, [], 0
                is_row = part.column(1).to_numpy(zero_copy_only=False)
                many = int((~is_row).sum())  # queries come first
                if many:
                    asked.append(part.slice(0, many))
                if many < len(is_row) and asked:
                    if best is None:
                        best, row, cells = begin()
                    held.append(part.slice(many))
                    size += len(is_row) - many
                    if size >= BLOCK_ROWS:
                        solve()
                        held, size = [], 0
        if held and best is not None:
            solve()
        yield from finish(held, best, row)

    return met.select("key", "is_row", "cell", "row", "vec_id", "vector").mapInArrow(run, "row long, query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, every: int = 100, k: int = 10, scale: float = 1024.0, vec_id: str = "vec_id", vector: str = "embedding", group_queries: int = GROUP_QUERIES, slice_rows: int = SLICE_ROWS, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id and score: of every row whose id `every` divides, the k best rows by inner product."""
    spark = vectors.sparkSession
    prepare(spark)
    work = Workspace(spark, "top-k")
    rows, width = whole(vectors, scale, vec_id, vector)
    rows = work.write(rows.withColumn("is_query", F.col("vec_id") % every == 0), "whole")
    total, asked = rows.agg(F.count("*"), F.count_if("is_query")).collect()[0]
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(1, total)) * (1 << 30))).select("vec_id", "vector")
    table = sample.orderBy(F.xxhash64("vec_id"), "vector").limit(2 * SAMPLE).toArrow()  # SAMPLE on average, and no more than twice that
    found = choose_pivots(matrix(table.column(1), width), max(1, min(pivots, int(asked**0.5))))
    placed = work.write(_placed(rows.select("vec_id", "vector"), found, width).withColumn("row", F.monotonically_increasing_id()).withColumn("is_query", F.col("vec_id") % every == 0), "placed")
    radius, reach, many = np.full(len(found), -1.0), np.zeros((2, len(found))), np.zeros(len(found), np.int64)
    of_query = F.col("is_query")
    for r in placed.groupBy("cell").agg(F.max("norm"), F.max("far"), F.max(F.when(of_query, F.col("far"))), F.count_if("is_query")).collect():  # a row for each pivot
        reach[:, r[0]], many[r[0]] = (r[1], r[2]), r[4]
        if r[4]:
            radius[r[0]] = r[3]
    bounds = Bounds(found, radius, reach)
    for cell, least in _best_bounds(placed, bounds, width, k).items():
        bounds.least[cell] = least
    bounds.settle()
    first, parts = _groups(found, many, group_queries)
    groups = int((first + parts).max())
    slices = max(-(-total // slice_rows), -(-partitions(spark) // groups))

    def copied(batches):
        """A row to every group of which a cell may need it."""
        for batch in batches:
            vector_, cell = matrix(batch.column(3), width), batch.column(0).to_numpy()
            needed = (bounds.range(vector_, bounds.cells)[1] >= bounds.least[bounds.cells][:, None]) & bounds.open[bounds.cells][:, cell]
            into = np.zeros((len(cell), groups), bool)
            for c, hit in zip(bounds.cells, needed):
                into[:, first[c] : first[c] + parts[c]] |= hit[:, None]
            at, group = np.nonzero(into)
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays([pa.array(group.astype(np.int64)), *(batch.column(i).take(take) for i in range(4))], ["group", "cell", "row", "vec_id", "vector"])

    copies = placed.select("cell", "row", "vec_id", "vector").mapInArrow(copied, "group long, cell int, row long, vec_id long, vector binary")
    copies = copies.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(slices)))
    part = F.element_at(F.array(*map(F.lit, first.tolist())), F.col("cell") + 1) + F.pmod(F.xxhash64("row", F.lit(5)), F.element_at(F.array(*map(F.lit, parts.tolist())), F.col("cell") + 1))
    queries = placed.where("is_query").select(part.alias("group"), "cell", "row", "vec_id", "vector", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"))
    both = queries.withColumn("is_row", F.lit(False)).unionByName(copies.withColumn("is_row", F.lit(True)))
    met = both.withColumn("key", F.col("group") * slices + F.col("slice")).repartition(max(partitions(spark), groups * slices), "key").sortWithinPartitions("key", "is_row")
    answers = _solved(met, bounds, width, k)
    place = F.expr("row_number() over (partition by row order by score desc, vec_id)")
    return answers.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
