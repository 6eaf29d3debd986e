"""Joins that hold up when one key owns a large share of the rows.

Routes, all with the same result:

* the right side is measured and fits: broadcast it, the left side does not move;
* no key is hot: a plain shuffle join, left to Catalyst and AQE;
* some keys are hot and the caller can tell the rows of a key apart: a hot key (NULL may be one)
  covers a grid of cells instead of one task, in the same single shuffle as all other keys;
* some keys are hot and rows may be exact copies, which no hash can part: rows of hot keys do not move
  but join a broadcast of the few right rows they need, and the rest shuffle as usual; if those right rows are
  too many, equal left rows are folded into counted pieces first, which hashes can part, and unfolded after.

Measuring looks at a sample only to choose the route; every row is joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, MapType, StringType, StructField, StructType

from clinflow.operators.rows import fold_copies, unfold_copies

_ROW_BYTES = 16
_COPIES = "__copies"
_PIECE = "__piece"


@dataclass(frozen=True)
class JoinLimits:
    """When to broadcast, and when a key counts as hot: from ``hot_rows`` rows on, or from a quarter of the rows of
    an average shuffle partition if that is more. So there are never more hot keys than four per partition."""

    broadcast_bytes: int = 64 << 20
    hot_rows: int = 2_000_000
    sample_fraction: float = 0.001


DEFAULT_LIMITS = JoinLimits()


def _value_bytes(df: DataFrame) -> Column:
    def width(field: StructField) -> Column:
        if isinstance(field.dataType, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(field.name), F.lit(0))
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        return F.lit(8)

    widths = [width(field) for field in df.schema]
    return sum(widths, F.lit(0)).cast("long")


def measured_sizes(frames: Mapping[str, DataFrame], enough: int) -> dict[str, int]:
    """Size of each frame's values, or some number above ``enough`` once that is certain.

    Rows are counted first: on stored tables that reads file footers only, so a table far too large
    to broadcast is recognized without reading its values. Two jobs at most, for all frames together.
    """

    def each(measure: Callable[[DataFrame], Column], names: Iterable[str]) -> dict[str, int]:
        parts = [frames[name].select(F.lit(name).alias("name"), measure(frames[name]).alias("n")) for name in names]
        if not parts:
            return {}
        # One aggregate over all frames: a single shuffle of a row per frame and task.
        sums = reduce(DataFrame.unionByName, parts).groupBy("name").agg(F.sum("n").alias("n"))
        return {row["name"]: row["n"] for row in sums.collect()}

    counted = each(lambda df: F.lit(1).cast("long"), frames)
    rows = {name: counted.get(name, 0) for name in frames}  # an empty frame has no group
    small = [name for name, n in rows.items() if n * _ROW_BYTES <= enough]
    values = each(_value_bytes, small)
    return {name: n * _ROW_BYTES + values.get(name, 0) for name, n in rows.items()}


def measured_bytes(df: DataFrame, enough: int) -> int:
    return measured_sizes({"it": df}, enough)["it"]


def hot_keys(
    df: DataFrame, on: Sequence[str], limits: JoinLimits, weight: str | None = None
) -> dict[tuple, int]:
    """Keys that own ``hot_rows`` rows or more, and a quarter of an average shuffle partition, with that number.

    Rows count once, or as often as their ``weight`` says; unweighted counts are estimated from a
    sample. What comes to the driver is bounded by four keys per shuffle partition; both sides of a
    join must see the same keys, also when a part of them is computed again.
    """
    share = 1.0 if weight else limits.sample_fraction
    keys = df.select(*on, *([weight] if weight else []))
    if share < 1:
        keys = keys.sample(share, seed=7)
    size = F.sum(weight) if weight else F.count(F.lit(1))
    total = keys.agg(size.alias("n")).first()["n"] or 0
    least = max(1, int(limits.hot_rows * share), total / _most_cells(df))
    if total < least:
        return {}  # not even all rows together would make one
    sized = keys.groupBy(*on).agg(size.alias("__rows")).filter(F.col("__rows") >= least)
    return {tuple(row[name] for name in on): int(row["__rows"] / share) for row in sized.collect()}


def _most_cells(df: DataFrame) -> int:
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _match(left: DataFrame, right: DataFrame, on: Sequence[str], prefix: str, null_safe: bool) -> Column:
    """Join condition between ``on`` and its renamed twin on the right."""
    condition = F.lit(True)
    for name in on:
        mine, theirs = left[name], right[prefix + name]
        condition = condition & (mine.eqNullSafe(theirs) if null_safe else mine == theirs)
    return condition


def _renamed(df: DataFrame, on: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({name: prefix + name for name in on})


def _join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, null_safe: bool = False) -> DataFrame:
    """Equi-join that keeps the left columns in place and the key only once."""
    twin = _renamed(right, on, "__right_")
    joined = left.join(twin, _match(left, twin, on, "__right_", null_safe), how)
    return joined.drop(*["__right_" + name for name in on])


def _grid_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    null_safe: bool,
    spread_by: Sequence[str],
    cells: DataFrame,
) -> DataFrame:
    """Join in which each hot key covers left cells x right cells instead of one task.

    A left row lies in one left cell and visits every right cell of its key; a right row the other
    way round; so each pair meets once. Cells follow from row content, which a retried task repeats.
    """

    def sized(df: DataFrame) -> DataFrame:
        with_cells = _join(df, F.broadcast(cells), on, "left", null_safe=True)
        return with_cells.fillna(1, ["__left_cells", "__right_cells"])

    def own(columns: Sequence[str], count: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    mine = sized(left).withColumn("__left_cell", own(spread_by, "__left_cells"))
    mine = mine.withColumn("__right_cell", every("__right_cells"))
    theirs = sized(right).withColumn("__right_cell", own(right.columns, "__right_cells"))
    theirs = theirs.withColumn("__left_cell", every("__left_cells")).drop("__left_cells", "__right_cells")
    theirs = theirs.withColumn("__met", F.lit(True))
    joined = _join(mine, theirs, [*on, "__left_cell", "__right_cell"], how, null_safe)
    if how == "left":
        # A key with several right cells has right rows, so a left row that met none there meets some elsewhere.
        joined = joined.filter((F.col("__right_cells") == 1) | F.col("__met").isNotNull())
    return joined.drop("__left_cells", "__right_cells", "__left_cell", "__right_cell", "__met")


def _cells(left: DataFrame, on: Sequence[str], left_hot: dict, right_hot: dict, limits: JoinLimits) -> DataFrame:
    """How many cells each hot key gets on either side: one row per hot key."""

    def count(hot: dict, key: tuple) -> int:
        return max(1, min(_most_cells(left), ceil(hot.get(key, 0) / limits.hot_rows)))

    sizes = [(*key, count(left_hot, key), count(right_hot, key)) for key in {**left_hot, **right_hot}]
    keys = [StructField(name, left.schema[name].dataType) for name in on]
    counts = [StructField(name, IntegerType()) for name in ("__left_cells", "__right_cells")]
    return left.sparkSession.createDataFrame(sizes, StructType(keys + counts))


def part_hot(df: DataFrame, on: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is in ``hot``, all others), NULL being a key like any other; nothing moves."""
    few = F.broadcast(hot.select(*on))
    return _join(df, few, on, "left_semi", null_safe=True), _join(df, few, on, "left_anti", null_safe=True)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    *,
    unique_right: bool = False,
    null_safe: bool = False,
    spread_by: Sequence[str] = (),
    right_bytes: int | None = None,
    right_hot: dict[tuple, int] | None = None,
    keys_from: DataFrame | None = None,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """``left`` joined to ``right`` on equal ``on`` columns, ``how`` being "left" or "left_anti".

    ``unique_right`` promises at most one right row per key. ``spread_by`` names columns that tell left
    rows of one key apart, such as a key they were deduplicated on; without it, and with a map among the
    columns of ``left``, equal rows cannot be found, which is refused. What the caller knows need not be measured: ``right_bytes``, an upper bound of the right side's size; ``right_hot``, its hot keys;
    ``keys_from``, a frame with the keys of ``left`` that is cheaper to read.
    """
    on = [on] if isinstance(on, str) else list(on)
    if not spread_by and any(isinstance(field.dataType, MapType) for field in left.schema):
        raise TypeError("rows with a map column need spread_by")
    size = measured_bytes(right, limits.broadcast_bytes) if right_bytes is None else right_bytes
    if size <= limits.broadcast_bytes and not right_hot:
        return _join(left, F.broadcast(right), on, how, null_safe)

    if how == "left_anti" and not unique_right:
        # Whether a key is there does not depend on how often.
        right, unique_right, right_hot = right.select(*on).distinct(), True, {}
    left_hot = hot_keys(left if keys_from is None else keys_from, on, limits)
    if right_hot is None:
        right_hot = {} if unique_right else hot_keys(right if null_safe else right.dropna(subset=on), on, limits)
    if not left_hot and not right_hot:
        return _join(left, right, on, how, null_safe)

    cells = _cells(left, on, left_hot, right_hot, limits)
    if spread_by:
        return _grid_join(left, right, on, how, null_safe, spread_by, cells)
    hot_right, _ = part_hot(right, on, cells)
    staying, moving = part_hot(left, on, cells)
    others = _join(moving, right, on, how, null_safe)
    if measured_bytes(hot_right, limits.broadcast_bytes) <= limits.broadcast_bytes:
        return _join(staying, F.broadcast(hot_right), on, how, null_safe).unionByName(others)
    folded = fold_copies(staying, left.columns, _COPIES, _PIECE, limits.hot_rows)
    met = _grid_join(folded, hot_right, on, how, null_safe, [*left.columns, _PIECE], cells)
    return unfold_copies(met, _COPIES).drop(_COPIES, _PIECE).unionByName(others)


def lookup(df: DataFrame, reference: DataFrame, on: str, **options) -> DataFrame:
    """Add the other columns of ``reference``, which has at most one row per ``on``; no match gives NULLs."""
    return spread_join(df, reference, on, "left", unique_right=True, **options)


def anti_join(
    df: DataFrame, keys: DataFrame, on: str | Sequence[str], limits: JoinLimits = DEFAULT_LIMITS, **options
) -> DataFrame:
    """Rows of ``df`` whose key is not among ``keys``; a NULL key equals none, so its row stays."""
    names = [on] if isinstance(on, str) else list(on)
    listed = keys.select(*names)
    # Measured before the keys are made distinct: an upper bound that needs no shuffle.
    size = measured_bytes(listed, limits.broadcast_bytes)
    return spread_join(
        df, listed.distinct(), names, "left_anti", unique_right=True, right_bytes=size, limits=limits, **options
    )
