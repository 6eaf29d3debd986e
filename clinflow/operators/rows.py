"""Whole-row and keyed set operators. Each combines on the map side, so copies collapse before they travel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_ORIGIN = "__in_removed"
_KEPT = "__kept"


def keep_one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by the other columns in order, where filled values beat NULLs.

    An aggregate rather than a ranked window: partial aggregation leaves at most one row per key
    and map task, however many copies a key has. The outcome does not depend on partitioning.
    """
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.max(F.struct(*others)).alias(_KEPT))
    return kept.select(*[F.col(name) if name in keys else F.col(f"{_KEPT}.{name}") for name in df.columns])


def except_rows(df: DataFrame, removed: DataFrame) -> DataFrame:
    """Distinct rows of ``df`` that are not in ``removed``, NULLs equal: one shuffle, no join."""
    both = df.withColumn(_ORIGIN, F.lit(False)).unionByName(
        removed.select(*df.columns).withColumn(_ORIGIN, F.lit(True))
    )
    seen = both.groupBy(*df.columns).agg(F.bool_or(_ORIGIN).alias(_ORIGIN))
    return seen.filter(~F.col(_ORIGIN)).drop(_ORIGIN)


def except_all_rows(df: DataFrame, removed: DataFrame) -> DataFrame:
    """Rows of ``df`` as often as it has them more than ``removed``, NULLs equal."""
    return _unfolded(_counted(df, removed), F.col("__mine") - F.col("__theirs"))


def intersect_all_rows(df: DataFrame, other: DataFrame) -> DataFrame:
    """Rows as often as both have them, NULLs equal."""
    return _unfolded(_counted(df, other), F.least("__mine", "__theirs"))


def _counted(df: DataFrame, other: DataFrame) -> DataFrame:
    """How often each row is in either frame: one aggregate, in which copies combine before they travel."""
    mine = df.withColumns({"__mine": F.lit(1).cast("long"), "__theirs": F.lit(0).cast("long")})
    theirs = other.select(*df.columns).withColumns({"__mine": F.lit(0).cast("long"), "__theirs": F.lit(1).cast("long")})
    return mine.unionByName(theirs).groupBy(*df.columns).agg(F.sum("__mine").alias("__mine"), F.sum("__theirs").alias("__theirs"))


def _unfolded(counted: DataFrame, copies: Column, most: int = 65_536) -> DataFrame:
    """Each row as often as ``copies`` says; very large numbers in pieces, so that no array is large."""
    names = [name for name in counted.columns if name not in ("__mine", "__theirs")]
    folded = counted.select(*names, copies.alias("__all")).filter("__all > 0")
    pieces = folded.withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__all") - 1) / most))))
    sized = pieces.withColumn("__n", F.least(F.lit(most).cast("long"), F.col("__all") - F.col("__piece") * most).cast("int"))
    return unfold_copies(sized, "__n").select(*names)


def union_rows(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name, copies kept."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def fold_copies(df: DataFrame, columns: Sequence[str], copies: str, piece: str, most: int) -> DataFrame:
    """Rows equal in ``columns`` become one row with their number in ``copies``.

    Partial aggregation folds them before the shuffle. A number above ``most`` is cut into several rows,
    which ``piece`` tells apart, so nothing after depends on how often a row repeats.
    """
    folded = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__all"))
    last = F.floor((F.col("__all") - 1) / most)
    pieces = folded.withColumn(piece, F.explode(F.sequence(F.lit(0).cast("long"), last)))
    size = F.least(F.lit(most).cast("long"), F.col("__all") - F.col(piece) * most)
    return pieces.select(*columns, size.cast("int").alias(copies), piece)


def unfold_copies(df: DataFrame, copies: str) -> DataFrame:
    """Each row as many times as ``copies`` says; a narrow step."""
    return df.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col(copies)))).drop("__copy")
