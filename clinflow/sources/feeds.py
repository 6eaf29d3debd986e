"""Readers: CSV feeds and parquet tables."""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


class MissingColumnsError(ValueError):
    """A feed or table lacks columns it must have."""


class RepeatedColumnsError(ValueError):
    """A header gives a name twice."""


def require_columns(present: Sequence[str] | DataFrame, required: Sequence[str]) -> None:
    """Fail at once, naming every absent column."""
    names = present.columns if isinstance(present, DataFrame) else present
    absent = [name for name in required if name not in names]
    if absent:
        raise MissingColumnsError(f"missing columns: {', '.join(absent)}")


def _header(spark: SparkSession, path: str) -> list[str]:
    """The names in the first line of a file of the feed, as written."""
    line = spark.read.text(path).head()
    return next(csv.reader([line.value.removeprefix("\ufeff")]), []) if line and line.value else []


def read_feed(spark: SparkSession, path: str, schema: StructType, required: Sequence[str] = ()) -> DataFrame:
    """Read one headed CSV file or a folder of them; every value stays the text it was.

    The header says where each column is. Names are matched without regard to case, unless the session
    is set to, and come out as the schema spells them; a column the schema does not know is kept. A file
    whose header differs from its neighbours' fails instead of shifting values into the wrong column.
    Types are applied later, where a value that cannot be read can be kept beside its NULL.
    """
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    fold = (lambda name: name) if exact else str.lower
    header = _header(spark, path)
    twice = [name for name, n in Counter(map(fold, header)).items() if n > 1]
    if twice:
        raise RepeatedColumnsError(f"columns named twice: {', '.join(twice)}")
    known = {fold(name): name for name in schema.names}
    names = [known.get(fold(name), name) for name in header]
    require_columns(names, required)
    as_text = StructType([StructField(name, StringType()) for name in header])
    return spark.read.schema(as_text).csv(path, header=True, enforceSchema=False).toDF(*names)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
