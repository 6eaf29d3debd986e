"""Episodes of care: encounters of a member that follow one another within a gap of days.

A member's days are dealt to ranges with all others, so a member with very many encounters is not one task's: each
range finds its own episodes from its days in order, and episodes at the ends of ranges that are near enough are joined by
what few rows the ranges report. Days repeat, so a member's encounters of one day collapse before they travel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clinflow.scratch import materialize

_RANGE = "__range"


def daily_counts(encounters: DataFrame, by: str, day: str) -> DataFrame:
    """(by, day, encounters): how many encounters a member has on a day."""
    known = encounters.filter(F.col(by).isNotNull() & F.col(day).isNotNull())
    return known.groupBy(by, F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("encounters"))


def episodes(encounters: DataFrame, by: str, day: str, gap_days: int, ranges: int | None = None) -> DataFrame:
    """(by, first_day, last_day, days, encounters) of every episode: days of one follow each other within ``gap_days``."""
    ranges = ranges or int(encounters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = daily_counts(encounters, by, day).repartitionByRange(ranges, by, "day")
    rows = materialize(dealt.withColumn(_RANGE, F.spark_partition_id()), "episode-days")
    # Episodes within a range.
    order = Window.partitionBy(by, _RANGE).orderBy("day")
    starts = F.coalesce(F.datediff("day", F.lag("day").over(order)) > gap_days, F.lit(True))
    numbered = rows.withColumn("__start", starts.cast("int"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = numbered.withColumn("__episode", F.sum("__start").over(upto))
    parts = numbered.groupBy(by, _RANGE, "__episode").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("days"), F.sum("encounters").alias("encounters")
    )
    return join_near(parts.drop("__episode"), by, gap_days)


def join_near(parts: DataFrame, by: str, gap_days: int) -> DataFrame:
    """Parts of episodes that do not overlap, joined where one begins within the gap after another.

    Only the first and last part of a range can have a neighbour in another, all others are episodes already.
    """
    of_range = Window.partitionBy(by, _RANGE)
    marked = parts.withColumns(
        {"__first": F.min("first_day").over(of_range), "__last": F.max("last_day").over(of_range)}
    )
    at_end = (F.col("first_day") == F.col("__first")) | (F.col("last_day") == F.col("__last"))
    marked = materialize(marked.withColumn("__open", at_end), "episode-parts")
    ends = marked.filter("__open")
    order = Window.partitionBy(by).orderBy("first_day")
    starts = F.coalesce(F.datediff("first_day", F.lag("last_day").over(order)) > gap_days, F.lit(True))
    # Between the two ends of a range there may be closed parts; they are farther than the gap from both.
    joined = ends.withColumn("__start", starts.cast("int"))
    joined = joined.withColumn("__episode", F.sum("__start").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = joined.groupBy(by, "__episode").agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.sum("days").alias("days"), F.sum("encounters").alias("encounters")
    )
    columns = [by, "first_day", "last_day", "days", "encounters"]
    return whole.select(*columns).unionByName(marked.filter("not __open").select(*columns))
