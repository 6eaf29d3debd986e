"""Bounded top-k per group: k rows a group leave a task, however many it read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

# Up to this rank Spark ranks rows before the shuffle as well, and lets no others travel.
MOST = 1000


def top_k(rows: DataFrame, group: Sequence[str], by: str, ties: Sequence[str], k: int, rank: str = "rank") -> DataFrame:
    """The ``k`` rows of greatest ``by`` per group with their rank from 1; equal ones by the least ``ties``, NULLs last."""
    if not 1 <= k <= MOST:
        raise ValueError(f"k must be 1 to {MOST}")
    order = [F.col(by).desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in ties]]
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col(rank) <= k)
