"""Tables that grow from run to run: keys that stay, and loads that can be repeated.

A registry is a stored dimension. Natural keys it knows keep their number and attributes; new ones are numbered behind the
greatest and appended. A load appends the rows whose key the target lacks. Both only look at what is stored when they
start, and an append is one job that Spark commits as a whole, so a run that failed is simply run again.

What is stored grows for years, a day's rows do not: once the stored keys are too many to broadcast, the keys of a day are broadcast to their
scan, so that of the stored keys only those that the day asks for leave their task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinflow.operators.joins import DEFAULT_LIMITS, JoinLimits, measured_bytes, spread_join
from clinflow.operators.numbering import ROWS_PER_TASK, number_rows
from clinflow.scratch import exists, materialize
from clinflow.sources.feeds import read_table


def lacking(rows: DataFrame, held: DataFrame, key: Sequence[str], limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """The ``rows`` whose ``key`` (NULL being a value) is in no row of ``held``, which may be very much larger.

    Past the broadcast limit on both sides they meet by a shuffle.
    """
    names = list(key)
    held = held.select(*names)
    size = measured_bytes(held, limits.broadcast_bytes)
    if size > limits.broadcast_bytes:
        asked = materialize(rows.select(*names).distinct(), "asked-keys")
        if measured_bytes(asked, limits.broadcast_bytes) <= limits.broadcast_bytes:
            twin = asked.withColumnsRenamed({name: f"__asked_{name}" for name in names})
            same = F.lit(True)
            for name in names:
                same = same & F.col(name).eqNullSafe(F.col(f"__asked_{name}"))
            held = materialize(held.join(F.broadcast(twin), same, "left_semi").distinct(), "held-keys")
            size = measured_bytes(held, limits.broadcast_bytes)
    once = held.distinct()
    return spread_join(rows, once, names, "left_anti", unique_right=True, null_safe=True, spread_by=names, right_bytes=size, limits=limits)


def new_keys(
    known: DataFrame | None,
    rows: DataFrame,
    natural: Sequence[str],
    key_name: str,
    rows_per_task: int = ROWS_PER_TASK,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """The ``rows``, one per natural key, that ``known`` lacks (NULL being a key), numbered behind its greatest number."""
    if known is None:
        return number_rows(rows, list(natural), key_name, rows_per_task)
    # Natural keys are unique on both sides, so none of them is hot.
    fresh = lacking(rows, known, natural, limits)
    last = known.agg(F.max(key_name).alias("last")).first()["last"] or 0
    numbered = number_rows(fresh, list(natural), key_name, rows_per_task)
    return numbered.withColumn(key_name, F.col(key_name) + F.lit(last))


def extend_registry(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    natural: Sequence[str],
    key_name: str,
    rows_per_task: int = ROWS_PER_TASK,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """The registry at ``path`` after the natural keys of ``rows`` that it lacked are added to it."""
    known = read_table(spark, path) if exists(spark, path) else None
    fresh = new_keys(known, rows, natural, key_name, rows_per_task, limits)
    # Stored before the append begins, which then reads no file of the table it adds to.
    materialize(fresh, f"new-{key_name}").write.mode("append").parquet(path)
    return read_table(spark, path)


def not_loaded(spark: SparkSession, path: str, rows: DataFrame, key: Sequence[str], limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """The ``rows`` whose ``key`` is in no row of the table at ``path``; all of them if there is no table yet."""
    if not exists(spark, path):
        return rows
    return lacking(rows, read_table(spark, path), key, limits)


def load_once(spark: SparkSession, path: str, rows: DataFrame, key: Sequence[str], limits: JoinLimits = DEFAULT_LIMITS) -> None:
    """Append the rows of keys that the table at ``path`` lacks; all rows of one key must come in one load."""
    materialize(not_loaded(spark, path, rows, key, limits), "load").write.mode("append").parquet(path)
