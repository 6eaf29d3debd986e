"""Standardization and the split into good and rejected rows. Every step is a narrow, one-scan row map."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructType

from clinflow.functions.columns import as_amount, as_date, clean_code, is_filled
from clinflow.rules import Rule
from clinflow.sources.feeds import require_columns


def standardize_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim and upper-case the listed columns that the frame has."""
    present = {name: clean_code(F.col(name)) for name in columns if name in df.columns}
    return df.withColumns(present) if present else df


def normalize_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn the listed columns into dates; what is no date becomes NULL and then fails its not-null rule."""
    return df.withColumns({name: as_date(F.col(name)) for name in columns})


_READERS = {DateType(): as_date, DoubleType(): as_amount}


def text_columns(df: DataFrame, schema: StructType) -> list[str]:
    """Columns that hold text but are dates or numbers by the schema."""
    held = {field.name: field.dataType for field in df.schema}
    return [f.name for f in schema if f.dataType in _READERS and held.get(f.name) == StringType()]


def with_types(df: DataFrame, schema: StructType, suffix: str | None = None) -> DataFrame:
    """Read text columns as the dates and numbers the schema says; what cannot be read becomes NULL.

    With a ``suffix``, the text stays beside its value under the name with the suffix.
    """
    names = text_columns(df, schema)
    kept = {name + suffix: F.col(name) for name in names} if suffix else {}
    read = {name: _READERS[schema[name].dataType](F.col(name)) for name in names}
    return df.withColumns({**kept, **read}) if names else df


def unread_values(df: DataFrame, schema: StructType) -> DataFrame:
    """One row: per text column, how many values were given that cannot be read as the schema says."""
    counts = [
        F.count_if(is_filled(F.col(name)) & _READERS[schema[name].dataType](F.col(name)).isNull()).alias(f"unread_{name}")
        for name in text_columns(df, schema)
    ]
    return df.agg(F.count(F.lit(1)).alias("rows_in"), *counts)


def applicable(df: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """Not-null rules need their column; non-negative rules on an absent column fall away."""
    require_columns(df, [rule.column for rule in rules if rule.kind == "not_null"])
    return [rule for rule in rules if rule.column in df.columns]


def _all_pass(rules: Sequence[Rule]) -> Column:
    return reduce(Column.__and__, [rule.passes() for rule in rules])


def split_rows(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(good, bad) by the rules: one filter and its exact complement over the same scan.

    Together they hold each input row once, NULLs and repeated rows included.
    """
    rules = applicable(df, rules)
    if not rules:
        return df, df.limit(0)
    passed = _all_pass(rules)
    return df.filter(passed), df.filter(~passed)


def tag_reasons(bad: DataFrame, rules: Sequence[Rule], reason: str) -> DataFrame:
    """Add the constant ``reason`` and ``reasons``, the names of all failed rules in rule order."""
    failed = [F.when(~rule.passes(), F.lit(rule.name)) for rule in applicable(bad, rules)]
    names = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    return bad.withColumns({"reason": F.lit(reason), "reasons": names})


def apply_rules(df: DataFrame, rules: Sequence[Rule], reason: str) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): the split, with the rejected rows tagged."""
    good, bad = split_rows(df, rules)
    return good, tag_reasons(bad, rules, reason)


def dq_summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: rows in, good and bad, and the failures of each rule. One scan, one aggregate."""
    rules = applicable(df, rules)
    passed = _all_pass(rules) if rules else F.lit(True)
    per_rule = [F.count_if(~rule.passes()).alias(f"failed_{rule.name}") for rule in rules]
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(passed).alias("rows_good"),
        F.count_if(~passed).alias("rows_bad"),
        *per_rule,
    )
