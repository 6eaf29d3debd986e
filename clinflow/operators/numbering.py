"""Dense, reproducible surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from clinflow.scratch import materialize, materialize_counted

# Up to this many rows one ordered window in a single task numbers them; beyond it, this many per task.
ROWS_PER_TASK = 1_000_000

_POSITION = "__position"
# monotonically_increasing_id keeps the partition above this bit and the row within it below.
_ROW_BITS = 33


def number_rows(
    keys: DataFrame, natural_key: str | Sequence[str], key_name: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Add ``key_name``: 1..n in the order of ``natural_key``, one column or several, NULL last.

    ``keys`` holds each natural key once. It is written out first: the numbers are then given once,
    to a fixed set of rows, and the row count that picks the route comes from the write.
    """
    kept, rows = materialize_counted(keys, f"keys-{key_name}")
    columns = [natural_key] if isinstance(natural_key, str) else natural_key
    order = [F.col(name).asc_nulls_last() for name in columns]
    if rows <= rows_per_task:
        return kept.withColumn(key_name, F.row_number().over(Window.orderBy(*order)).cast("long"))
    return _number_ranges(kept, order, key_name, ceil(rows / rows_per_task))


def _number_ranges(keys: DataFrame, order: Sequence[Column], key_name: str, ranges: int) -> DataFrame:
    """Sort in ranges, number within each, then shift each range by the rows before it.

    Range bounds are sampled, so a second run could cut elsewhere: positions are written out
    before anything is derived from them. Only one count per range reaches the driver.
    """
    ordered = keys.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = materialize(ordered.withColumn(_POSITION, F.monotonically_increasing_id()), f"order-{key_name}")
    part = F.shiftright(_POSITION, _ROW_BITS).cast("int")
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect())
    starts = [0, *accumulate(size for _, size in sizes)]
    offsets = keys.sparkSession.createDataFrame(
        [(p, start) for (p, _), start in zip(sizes, starts)], "__part int, __before long"
    )
    row = F.col(_POSITION).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    shifted = placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return shifted.select(*keys.columns, (F.col("__before") + row + 1).alias(key_name))
