"""Subtotals over a fact that repeats measures: every claim counts once within every group of every level.

A claim has one row per encounter, so it is in several groups of a level, or in one group several times. Rows expand to
the levels asked for; within a level, copies of a claim in one group collapse, and what is left is summed. All steps
combine on the map side, so the grand total is no hot spot. Amounts are summed as decimals: the same total in every run.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

LEVEL = "level"
_AMOUNT = "decimal(18,2)"


def rollup_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    """All of the dimensions, all but the last, and so on to none."""
    return [tuple(dims[:n]) for n in range(len(dims), -1, -1)]


def cube_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [group for n in range(len(dims), -1, -1) for group in combinations(dims, n)]


def totals_once(
    fact: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]], claim: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """dims, ``level``, ``claims`` and the sum of each measure, per group of each of the ``sets`` of dimensions.

    ``claim`` names what a measure belongs to: rows alike in it hold the same measures. ``level`` has a bit per dimension,
    the last one lowest, set where the row is a total over that dimension; so a NULL of the data is told from a total.
    """
    # One row per claim and group at the finest level, before rows multiply by the number of levels.
    amounts = [F.max(F.col(name).cast(_AMOUNT)).alias(name) for name in measures]
    finest = fact.groupBy(*claim, *dims).agg(*amounts)
    shapes = []
    for group in sets:
        level = sum(1 << (len(dims) - 1 - i) for i, name in enumerate(dims) if name not in group)
        kept = [(F.col(name) if name in group else F.lit(None).cast(fact.schema[name].dataType)).alias(name) for name in dims]
        shapes.append(F.struct(*kept, F.lit(level).alias(LEVEL)))
    expanded = finest.select(*claim, *measures, F.explode(F.array(*shapes)).alias("__shape")).select(*claim, *measures, "__shape.*")
    once = expanded.groupBy(LEVEL, *dims, *claim).agg(*[F.max(name).alias(name) for name in measures])
    sums = [F.sum(name).cast("double").alias(name) for name in measures]
    return once.groupBy(LEVEL, *dims).agg(F.count(F.lit(1)).alias("claims"), *sums)
