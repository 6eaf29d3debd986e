"""The fact as a catalog table by month and member bucket.

A filter on the month reads that month's folders alone; a join on the member with a table of the same buckets moves no row of the fact;
a month that is computed again replaces its own folders and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MONTH = "month"


def month_of(day: Column) -> Column:
    """The month as text, such as 1995-03; days that are missing have a month of their own."""
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit("none"))


def _dealt(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """A month's bucket in one task, so that it becomes one file."""
    return df.repartition(MONTH, F.pmod(F.hash(key), F.lit(buckets)))


def write_by_month(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Create ``table`` at ``path`` from rows that have a column ``month``, partitioned by it and bucketed by ``key``."""
    writer = _dealt(df, key, buckets).write.partitionBy(MONTH).bucketBy(buckets, key).sortBy(key)
    # An option of the table, so that every later insert replaces only the months it brings.
    writer.option("path", path).option("partitionOverwriteMode", "dynamic").saveAsTable(table)


def bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Create a table of the same buckets without months, such as a dimension the fact is joined with."""
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def replace_months(spark: SparkSession, table: str, df: DataFrame, key: str, buckets: int) -> None:
    """Put the rows of ``df`` in place of all rows of the months it holds; other months of a table of ``write_by_month`` stay."""
    columns = spark.table(table).columns
    _dealt(df, key, buckets).select(*columns).write.mode("overwrite").insertInto(table)
