"""Interval join: rows whose day lies in a period of the same member, by time bins and an exact test behind.

Periods are cut into the bins that they touch, and a day is in one bin, so both sides meet on member and bin by an ordinary
join. Bins of ``width`` days suit periods of less than ``RATIO`` times that; longer ones have bins ``RATIO`` times as wide, and so on,
so a period is in ``RATIO`` + 1 bins at most, however long it is, and its bins span few days beside its own. Each width
is a join of its own; the periods are stored first, which tells the widths in use. A member with very many rows is spread over its bins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from clinflow.operators.joins import DEFAULT_LIMITS, JoinLimits, measured_sizes
from clinflow.scratch import materialize

# How many times wider the next kind of bins is.
RATIO = 8
# No two days of Spark's dates are farther apart than 2 ** 32 days.
_MOST_DAYS = 1 << 32
_KIND = "__kind"


def _bin(day: str, width: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(width).cast("long")).cast("int")


def _kind(span: tuple[str, str], width: int) -> Column:
    """0 for periods that suit bins of ``width`` days, 1 for those that suit the next wider bins, and so on."""
    first, last = (F.unix_date(day).cast("long") for day in span)
    bounds, bound = [], width * RATIO
    while bound < _MOST_DAYS:
        bounds.append((last - first >= F.lit(bound).cast("long")).cast("int"))
        bound *= RATIO
    return sum(bounds, F.lit(0))


def cut_periods(periods: DataFrame, span: tuple[str, str], width: int) -> dict[int, DataFrame]:
    """By width of the bins, the periods that suit it, a row for each bin they touch, its number in ``__bin``."""
    first, last = span
    kinds = Observation()
    valid = periods.filter(F.col(first) <= F.col(last)).withColumn(_KIND, _kind(span, width))
    kept = materialize(valid.observe(kinds, F.bit_or(F.expr(f"shiftleft(1L, {_KIND})")).alias("used")), "periods")
    used = kinds.get.get("used") or 1  # without any period, as if there were short ones
    widths = {kind: width * RATIO**kind for kind in range(used.bit_length()) if used >> kind & 1}
    return {
        wide: kept.filter(F.col(_KIND) == kind).drop(_KIND).withColumn("__bin", F.explode(F.sequence(_bin(first, wide), _bin(last, wide))))
        for kind, wide in widths.items()
    }


def within(
    points: DataFrame,
    periods: DataFrame,
    by: str,
    day: str,
    span: tuple[str, str],
    width: int = 32,
    how: str = "inner",
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """``points`` with the columns of every period of the same ``by`` that holds their ``day``, both ends included.

    ``how`` is "inner", or "left" to keep points in no period. Points and periods without member or day meet nothing, nor do
    periods that end before they begin.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown kind of join: {how}")
    cuts = {wide: cut.withColumnRenamed(by, "__by") for wide, cut in cut_periods(periods.filter(F.col(by).isNotNull()), span, width).items()}
    # Spark takes a period for one row, however many bins it is in: whether they fit a broadcast is measured.
    sizes = measured_sizes({str(wide): cut for wide, cut in cuts.items()}, limits.broadcast_bytes)
    if len(cuts) > 1:
        points = materialize(points, "points")

    def met(asking: DataFrame, wide: int, kind: str) -> DataFrame:
        same = (F.col(by) == F.col("__by")) & (F.col("__at") == F.col("__bin")) & F.col(day).between(*[F.col(end) for end in span])
        cut = F.broadcast(cuts[wide]) if sizes[str(wide)] <= limits.broadcast_bytes else cuts[wide].hint("merge")
        return asking.withColumn("__at", _bin(day, wide)).join(cut, same, kind).drop("__by", "__bin", "__at")

    if len(cuts) == 1:
        return met(points, *cuts, how)
    found = reduce(DataFrame.union, [met(points, wide, "inner") for wide in cuts])
    if how == "inner":
        return found
    alone = reduce(lambda rest, wide: met(rest, wide, "left_anti"), cuts, points)
    added = [F.lit(None).cast(field.dataType).alias(field.name) for field in periods.schema if field.name != by]
    return found.union(alone.select("*", *added))
