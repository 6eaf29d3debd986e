"""As-of join in linear work: for each row the row of the other side that is last before it, first after it, or nearest.

Both sides become one list ordered by key and day, in which every row takes over the last value before it and the next one
behind it; no pairs are formed. The list is dealt to ranges of about equal number by key and day, so a key with very
many rows spans several ranges, and what its ranges end with is carried over to their neighbours: at most two small rows a
range. Rows of one key and day of the right side collapse to one first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clinflow.scratch import materialize

_RANGE, _KEY, _DAY, _RIGHT, _ROW, _VALUE = "__range", "__key", "__day", "__right", "__row", "__value"
DIRECTIONS = ("backward", "forward", "nearest")


def _dealt(left: DataFrame, right: DataFrame, ranges: int) -> DataFrame:
    """Both sides stored with the number of their range, which rises with key and day."""
    both = left.unionByName(right, allowMissingColumns=True)
    # Rows of one key and day part too: the last column tells them apart.
    dealt = both.repartitionByRange(ranges, _KEY, _DAY, F.desc(_RIGHT), F.xxhash64(_ROW))
    return materialize(dealt.withColumn(_RANGE, F.spark_partition_id()), "as-of")


def _carried(rows: DataFrame) -> DataFrame:
    """(key, range, before, after) of the keys that span ranges: the last value of an earlier range, the first of a later one.

    Only the first and the last key of a range can go on in another, so there are at most two rows a range.
    """
    ends = rows.groupBy(_RANGE).agg(F.min(_KEY).alias("first"), F.max(_KEY).alias("last"))
    split = ends.select(F.explode(F.array_distinct(F.array("first", "last"))).alias(_KEY)).groupBy(_KEY).count()
    split = split.filter("count > 1").select(_KEY)
    of_split = rows.join(F.broadcast(split), _KEY, "left_semi")
    value = F.when(F.col(_RIGHT), F.struct(_DAY, _VALUE))
    per_range = of_split.groupBy(_KEY, _RANGE).agg(F.min(value).alias("least"), F.max(value).alias("greatest"))
    earlier = Window.partitionBy(_KEY).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(_KEY).orderBy(F.desc(_RANGE)).rowsBetween(Window.unboundedPreceding, -1)
    before = F.last("greatest", ignorenulls=True).over(earlier).alias("__carried_before")
    after = F.last("least", ignorenulls=True).over(later).alias("__carried_after")
    return per_range.select(_KEY, _RANGE, before, after)


def as_of(
    left: DataFrame,
    right: DataFrame,
    by: str,
    on: tuple[str, str],
    values: Sequence[str],
    direction: str = "backward",
    tolerance: int | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``left`` with the ``values`` of the right row of the same ``by`` that is nearest in the given direction, else NULLs.

    ``on`` names the day of either side. "backward" looks to the same day and before, "forward" to the same day
    and after. Of right rows of one day, and of two that are equally near, the least by ``values`` in order counts, so a key
    should come first. No row farther than ``tolerance`` days counts. Left rows without key or day meet none, and right rows
    without are met by none; every left row comes out once.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"unknown direction: {direction}")
    left_day, right_day = on
    ranges = ranges or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    can_meet = F.col(by).isNotNull() & F.col(left_day).isNotNull()
    # Key and day travel once; a struct needs a column at least.
    carried = [name for name in left.columns if name not in (by, left_day)] or [by]
    asking = left.filter(can_meet).select(
        F.col(by).alias(_KEY), F.col(left_day).alias(_DAY), F.lit(False).alias(_RIGHT), F.struct(*carried).alias(_ROW)
    )
    offered = right.filter(F.col(by).isNotNull() & F.col(right_day).isNotNull())
    offered = offered.groupBy(F.col(by).alias(_KEY), F.col(right_day).alias(_DAY)).agg(F.min(F.struct(*values)).alias(_VALUE))
    rows = _dealt(asking, offered.withColumn(_RIGHT, F.lit(True)), ranges)

    at = F.when(F.col(_RIGHT), F.struct(_DAY, _VALUE))
    within = Window.partitionBy(_KEY, _RANGE)
    upwards = within.orderBy(_DAY, F.desc(_RIGHT)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    downwards = within.orderBy(F.desc(_DAY), F.desc(_RIGHT)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.join(F.broadcast(_carried(rows)), [_KEY, _RANGE], "left")
    found = found.withColumn("__before", F.coalesce(F.last(at, ignorenulls=True).over(upwards), "__carried_before"))
    sides = ["__before"]
    if direction != "backward":
        after = F.coalesce(F.last(at, ignorenulls=True).over(downwards), "__carried_after")
        # Right rows of a day stand before the left ones, maybe in the range before.
        same_day = F.when(F.col(f"__before.{_DAY}") == F.col(_DAY), F.col("__before"))
        found = found.withColumn("__after", F.coalesce(same_day, after))
        sides = ["__before", "__after"] if direction == "nearest" else ["__after"]
    found = found.filter(~F.col(_RIGHT))

    def candidate(side: str) -> Column:
        days = F.abs(F.datediff(_DAY, f"{side}.{_DAY}"))
        near = F.col(side).isNotNull() if tolerance is None else days <= tolerance
        return F.when(near, F.struct(days.alias("days"), F.col(f"{side}.{_VALUE}").alias("value")))

    each = [candidate(side) for side in sides]
    best = F.least(*each) if len(each) > 1 else each[0]

    def own(name: str) -> Column:
        column = F.col(f"{_ROW}.{name}") if name in carried else F.col(_KEY if name == by else _DAY)
        return column.cast(left.schema[name].dataType).alias(name)

    met = found.withColumn("__best", best)
    met = met.select(*[own(name) for name in left.columns], *[F.col(f"__best.value.{name}").alias(name) for name in values])
    types = {name: right.schema[name].dataType for name in values}
    alone = left.filter(~can_meet).withColumns({name: F.lit(None).cast(types[name]) for name in values})
    return met.unionByName(alone)
