"""Types of a feed, found in one scan of its text.

Every value climbs a lattice of types: what reads as a date may be a date, a whole number without leading zero may be a
number, anything may be text. A column's type is the narrowest that all its filled values have in common. The aggregate is
a few flags per column, which merge in any order. Columns that are identifiers or codes by name stay text whatever they hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from clinflow.functions.columns import as_amount, as_date, is_filled

# Names that mark identifiers and codes.
TEXT_NAMES = r"(^|_)(id|code|zip|key)$"
# Narrowest first; what fits none of them is text.
LATTICE = {"date": DateType(), "bigint": LongType(), "double": DoubleType(), "string": StringType()}
_WHOLE = r"^-?(0|[1-9][0-9]{0,17})$"
_PADDED = r"^-?0[0-9]"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _fits(value: Column) -> dict[str, Column]:
    plain = F.trim(value)
    number = as_amount(plain).isNotNull() & ~plain.rlike(_PADDED) & plain.rlike(r"[0-9]")
    return {
        "date": plain.rlike(_DAY) & as_date(plain).isNotNull(),
        "bigint": plain.rlike(_WHOLE),
        "double": number,
        "string": F.lit(True),
    }


def profile(feed: DataFrame) -> DataFrame:
    """One row per column: ``column_name``, ``filled`` and ``empty`` values, ``longest`` of them and the ``type`` they share."""
    parts = []
    for name in feed.columns:
        value = F.col(f"`{name}`").cast("string")
        filled = is_filled(value)
        fits = {kind: F.coalesce(F.bool_and(F.when(filled, fit)), F.lit(False)) for kind, fit in _fits(value).items()}
        common = F.coalesce(*[F.when(fit, F.lit(kind)) for kind, fit in fits.items()], F.lit("string"))
        text = F.lit(name).rlike(TEXT_NAMES)
        parts.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count_if(filled).alias("filled"),
                F.count_if(~filled).alias("empty"),
                F.coalesce(F.max(F.char_length(value)), F.lit(0)).alias("longest"),
                F.when(text, F.lit("string")).otherwise(common).alias("type"),
            )
        )
    return feed.agg(F.array(*parts).alias("columns")).select(F.inline("columns"))


def proposed_schema(feed: DataFrame) -> StructType:
    """The schema the values of the feed allow, columns in their order."""
    found = {row["column_name"]: LATTICE[row["type"]] for row in profile(feed).collect()}
    return StructType([StructField(name, found[name]) for name in feed.columns])
