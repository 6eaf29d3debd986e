"""Column expressions. All are built-in functions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def is_filled(column: Column) -> Column:
    """True when the value is neither NULL nor only spaces; never NULL itself."""
    return column.isNotNull() & (F.trim(column.cast("string")) != "")


def is_negative(column: Column) -> Column:
    """True for numbers below zero; NULL, NaN, -0.0 and text that is no number are not. Never NULL itself."""
    amount = as_amount(column)
    return amount.isNotNull() & (amount < 0)


def clean_code(column: Column) -> Column:
    return F.upper(F.trim(column.cast("string")))


def as_date(column: Column) -> Column:
    """Date of the value, NULL where it cannot be read as one (also under ANSI mode)."""
    return F.try_to_date(column)


def as_amount(column: Column) -> Column:
    """Double of the value, NULL where it cannot be read as one (also under ANSI mode)."""
    return column.try_cast("double")


def member_key(identifier: Column, salt: str) -> Column:
    """Salted SHA-256 of an identifier as 64 hex digits; a NULL identifier has no key.

    Guessable identifiers can be found again by whoever knows the salt: treat it as a secret.
    """
    if not salt:
        raise ValueError("a non-empty salt is required")
    digest = F.sha2(F.concat_ws("||", identifier.cast("string"), F.lit(salt)), 256)
    return F.when(identifier.isNotNull(), digest)


def known_code(column: Column, missing: Sequence[str] = ()) -> Column:
    """The code, with the listed stand-ins for "no code" turned into NULL."""
    return F.when(~column.isin(*missing), column) if missing else column


def first_code(*columns: Column, missing: Sequence[str] = ()) -> Column:
    return F.coalesce(*[known_code(c, missing) for c in columns])


def calendar_parts(date: Column) -> dict[str, Column]:
    return {"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)}
