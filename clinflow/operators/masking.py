"""De-identification: salted keys instead of identifiers, personal columns removed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from clinflow.functions.columns import member_key
from clinflow.operators.joins import DEFAULT_LIMITS, JoinLimits, lookup, measured_bytes
from clinflow.schemas import PHI_COLUMNS

_KEY_DIGITS = 64


def deidentify(
    df: DataFrame, salt: str, id_column: str = "patient_id", phi_columns: Sequence[str] = PHI_COLUMNS
) -> DataFrame:
    """Add ``member_key``; drop the identifier it stands for and every personal column present."""
    keyed = df.withColumn("member_key", member_key(F.col(id_column), salt))
    return keyed.drop(id_column, *phi_columns)


@dataclass(frozen=True)
class KeyMapping:
    """Identifier to key, one row per known identifier, with an upper bound of its size."""

    table: DataFrame
    id_column: str
    size_bound: int


def key_mapping(
    patients: DataFrame, salt: str, id_column: str = "patient_id", limits: JoinLimits = DEFAULT_LIMITS
) -> KeyMapping:
    """Keys of the identifiers that occur; each is hashed once, after the identifiers are made distinct.

    The mapping undoes the masking, so it is never written out, not even to the scratch folder.
    """
    known = patients.select(id_column).filter(F.col(id_column).isNotNull())
    room = measured_bytes(known.withColumn("__key", F.lit(" " * _KEY_DIGITS)), limits.broadcast_bytes)
    keyed = known.distinct().withColumn("member_key", member_key(F.col(id_column), salt))
    return KeyMapping(keyed, id_column, room)


def replace_id(df: DataFrame, id_column: str, mapping: KeyMapping, **options) -> DataFrame:
    """Swap ``id_column`` for the ``member_key`` of the identifier; an unknown one gets NULL."""
    reference = mapping.table.withColumnRenamed(mapping.id_column, id_column)
    return lookup(df, reference, id_column, right_bytes=mapping.size_bound, **options).drop(id_column)
