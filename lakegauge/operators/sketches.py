"""Mergeable states of rollups beyond sums: distinct counts and quantiles of coarser buckets come from the states of finer ones.

Distinct counts have HyperLogLog registers (Flajolet and others 2007), a row for each that is set, which
merge by the maximum. Quantiles have cells: counts of values by powers of GAMMA, which merge by
addition and give every quantile within one percent. Both come out the same from hours as from rows.
Spark's own HLL sketches keep an estimate of the order in which they were filled, and its KLL sketches
drop rows at random, so neither does that; KLL sketches are offered for ranks within their error.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^REGISTER_BITS registers: a standard error of some 1.04 / 2^(REGISTER_BITS / 2). RANK_K: ranks within some 1.65 / RANK_K.
REGISTER_BITS, RANK_K = 12, 200
#: A cell's ends have this ratio, so its middle is within a percent of all its values.
GAMMA = 1.02


def cell(value: Column) -> Column:
    """(sign, power): values of (GAMMA^(power - 1), GAMMA^power], by the size of the negative ones; 0 is a cell by itself, and null and NaN have none."""
    sign = F.signum(value).cast("int")
    power = F.when(sign == 0, 0).otherwise(F.ceil(F.log(F.abs(value)) / math.log(GAMMA)).cast("int"))
    return F.when(value.isNotNull() & ~F.isnan(value), F.struct(sign.alias("sign"), power.alias("power")))


def middle(of: Column) -> Column:
    """A value of the cell that is within a percent of all."""
    return of["sign"] * F.pow(F.lit(GAMMA), of["power"] - 1) * (1 + GAMMA) / 2


def registers(df: DataFrame, dims: Sequence[str], bucket: Column, distinct: str) -> DataFrame:
    """dims, bucket, register, top: a row for each register that a value has set; null is no value."""
    rest = 64 - REGISTER_BITS
    h = F.xxhash64(distinct)
    low = h.bitwiseAND(F.lit((1 << rest) - 1))
    rows = df.where(F.col(distinct).isNotNull()).select(*dims, bucket.alias("bucket"), F.shiftrightunsigned(h, rest).cast("int").alias("register"), F.when(low == 0, rest + 1).otherwise(rest + 1 - F.length(F.bin(low))).alias("top"))
    return rows.groupBy(*dims, "bucket", "register").agg(F.max("top").alias("top"))


def merged_registers(registers_: DataFrame, dims: Sequence[str], bucket: Column) -> DataFrame:
    """Registers of coarser groups: the same rows as from the values themselves."""
    return registers_.groupBy(*dims, bucket.alias("bucket"), "register").agg(F.max("top").alias("top"))


def distinct_estimates(registers_: DataFrame, dims: Sequence[str]) -> DataFrame:
    """dims, bucket and distinct, the estimated number of values."""
    m = 1 << REGISTER_BITS
    grouped = registers_.groupBy(*dims, "bucket").agg(F.count("*").alias("set"), F.sum(F.pow(F.lit(2.0), -F.col("top"))).alias("sum"))
    empty = m - F.col("set")
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / (F.col("sum") + empty)
    best = F.when((raw <= 2.5 * m) & (empty > 0), m * F.log(m / empty)).otherwise(raw)
    return grouped.select(*dims, "bucket", F.round(best).cast("long").alias("distinct"))


def ranks(df: DataFrame, dims: Sequence[str], bucket: Column, value: str) -> DataFrame:
    """dims, bucket, n, rank_state: a KLL sketch of each group's values."""
    return df.groupBy(*dims, bucket.alias("bucket")).agg(F.count("*").alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), RANK_K).alias("rank_state"))


def merged_ranks(states: DataFrame, dims: Sequence[str], bucket: Column) -> DataFrame:
    """States of coarser groups."""
    return states.groupBy(*dims, bucket.alias("bucket")).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("rank_state").alias("rank_state"))


def rank_quantile(share: float) -> Column:
    """A value whose rank is near the share."""
    return F.kll_sketch_get_quantile_double("rank_state", F.lit(share))


def cells(df: DataFrame, dims: Sequence[str], bucket: Column, value: str) -> DataFrame:
    """dims, bucket, sign, power, n: a row for each cell that has values."""
    rows = df.select(*dims, bucket.alias("bucket"), cell(F.col(value).cast("double")).alias("c")).where("c is not null")
    return rows.groupBy(*dims, "bucket", F.col("c.sign").alias("sign"), F.col("c.power").alias("power")).agg(F.count("*").alias("n"))


def merged_cells(cells_: DataFrame, dims: Sequence[str], bucket: Column) -> DataFrame:
    """Cells of coarser groups: the same rows as from the values themselves."""
    return cells_.groupBy(*dims, bucket.alias("bucket"), "sign", "power").agg(F.sum("n").alias("n"))


def cell_quantiles(cells_: DataFrame, dims: Sequence[str], share: float) -> DataFrame:
    """dims, bucket, n, sign, power and quantile: the cell that holds the value of rank floor(share * (n - 1)), from 0."""
    entry = F.struct("sign", (F.col("sign") * F.col("power")).alias("place"), "power", "n")
    # a group's cells are bounded by the range of doubles, some 140,000
    grouped = cells_.groupBy(*dims, "bucket").agg(F.array_sort(F.collect_list(entry)).alias("c"), F.sum("n").alias("n"))
    rank = F.floor(F.lit(share) * (F.col("n") - 1))
    step = lambda a, c: F.struct((a["seen"] + c["n"]).alias("seen"), F.when(a["at"].isNotNull(), a["at"]).when(a["seen"] + c["n"] > rank, F.struct(c["sign"].alias("sign"), c["power"].alias("power"))).alias("at"))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("struct<sign:int,power:int>").alias("at"))
    found = grouped.withColumn("at", F.aggregate("c", start, step)["at"])
    return found.select(*dims, "bucket", "n", F.col("at.sign").alias("sign"), F.col("at.power").alias("power"), middle(F.col("at")).alias("quantile"))
