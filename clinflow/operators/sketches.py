"""Sketches that are stored per day and merged when read: distinct counts and quantiles without the rows they came from.

Distinct counts are HyperLogLog sketches of 2^``LG_K`` registers: the relative standard error is about 1.04 / sqrt(2^LG_K), 1.6% here. Quantiles
are counts per logarithmic bucket, whose bounds differ by the factor (1 + e) / (1 - e): the value a bucket stands for is
within the share e of every value in it, so a quantile is within e of the true one. Both merge by aggregates that combine
on the map side, in any order; a day's buckets are few whatever the number of its rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

LG_K = 12
DISTINCT_ERROR = 1.04 / math.sqrt(1 << LG_K)


def distinct_sketches(rows: DataFrame, groups: Sequence[str], column: str) -> DataFrame:
    """groups and ``sketch``: one sketch of the values of ``column`` per group; NULLs do not count."""
    return rows.groupBy(*groups).agg(F.hll_sketch_agg(column, LG_K).alias("sketch"))


def merged_distinct(sketches: DataFrame, groups: Sequence[str], name: str = "estimate") -> DataFrame:
    """The estimated number of distinct values per coarser group, from sketches alone."""
    return sketches.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def _bucket(value: Column, error: float) -> Column:
    growth = math.log((1 + error) / (1 - error))
    size = F.ceil(F.log(F.abs(value)) / F.lit(growth)).cast("int")
    return F.when(value != 0, size)


def quantile_sketches(rows: DataFrame, groups: Sequence[str], column: str, error: float = 0.01) -> DataFrame:
    """groups, ``sign``, ``bucket`` and ``n``: how many values of a group are in each bucket; NULL and NaN do not count."""
    value = F.col(column).cast("double")
    known = rows.filter(value.isNotNull() & ~F.isnan(value))
    return known.groupBy(*groups, F.signum(value).cast("int").alias("sign"), _bucket(value, error).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merged_quantiles(sketches: DataFrame, groups: Sequence[str], shares: Sequence[float], error: float = 0.01) -> DataFrame:
    """groups, ``share`` and ``value``: quantiles per coarser group, each within the share ``error`` of the true value.

    The quantile of a share is the least value that at least this share of the values does not exceed.
    """
    summed = sketches.groupBy(*groups, "sign", "bucket").agg(F.sum("n").alias("n"))
    growth = (1 + error) / (1 - error)
    # The value that is within the error of both ends of its bucket.
    middle = 2 * F.pow(F.lit(growth), F.col("bucket")) / (growth + 1)
    valued = summed.withColumn("value", F.when(F.col("sign") == 0, 0.0).otherwise(F.col("sign") * middle))
    # A group has as many rows here as it has buckets.
    order = Window.partitionBy(*groups).orderBy("value")
    placed = valued.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy(*groups)))
    wanted = placed.withColumn("share", F.explode(F.array(*map(F.lit, shares))))
    reached = wanted.filter(F.col("upto") >= F.greatest(F.ceil(F.col("share") * F.col("all")), F.lit(1)))
    return reached.groupBy(*groups, "share").agg(F.min("value").alias("value"))
