"""Column contracts: the raw feeds, the rules that apply to them and the warehouse tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _feed(**types: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


# Ids, codes and zip stay strings even where every value is digits, so leading zeros survive.
CLAIMS = _feed(
    claim_id=StringType(),
    member_id=StringType(),
    provider_id=StringType(),
    service_date=DateType(),
    paid_amount=DoubleType(),
    allowed_amount=DoubleType(),
    icd10_code=StringType(),
    cpt_code=StringType(),
)

PATIENTS = _feed(
    patient_id=StringType(),
    first_name=StringType(),
    last_name=StringType(),
    dob=DateType(),
    zip=StringType(),
    gender=StringType(),
)

ENCOUNTERS = _feed(
    encounter_id=StringType(),
    patient_id=StringType(),
    provider_id=StringType(),
    encounter_date=DateType(),
    diagnosis_code=StringType(),
    procedure_code=StringType(),
)

# Fixed value: personal columns that must not leave the curated zone.
PHI_COLUMNS = ("first_name", "last_name", "dob", "zip")

# The keys on which repeated rows count as one record.
CLAIM_KEY = ("claim_id", "service_date")
ENCOUNTER_KEY = ("encounter_id",)

# The constant tag of a rejected row, per data set.
CLAIMS_REASON = "claims_dq_failed"
EHR_REASON = "ehr_dq_failed"


@dataclass(frozen=True)
class TableContract:
    """Types, text lengths and key constraints a warehouse table promises."""

    name: str
    columns: StructType
    max_length: dict[str, int]
    not_null: tuple[str, ...] = ()
    primary_key: str | None = None


def _contract(name: str, columns: StructType, max_length: dict[str, int], **constraints) -> TableContract:
    return TableContract(name, columns, max_length, **constraints)


# The warehouse tables (types, lengths, keys).
DIM_MEMBER = _contract(
    "dim_member",
    _feed(member_sk=LongType(), member_key=StringType(), gender=StringType()),
    {"member_key": 64, "gender": 10},
    not_null=("member_key",),
    primary_key="member_sk",
)
DIM_PROVIDER = _contract(
    "dim_provider",
    _feed(provider_sk=LongType(), provider_id=StringType()),
    {"provider_id": 32},
    not_null=("provider_id",),
    primary_key="provider_sk",
)
DIM_DIAGNOSIS = _contract(
    "dim_diagnosis",
    _feed(diagnosis_sk=LongType(), final_diagnosis=StringType()),
    {"final_diagnosis": 32},
    primary_key="diagnosis_sk",
)
DIM_DATE = _contract(
    "dim_date",
    _feed(date_sk=LongType(), date=DateType(), year=IntegerType(), month=IntegerType(), day=IntegerType()),
    {},
    primary_key="date_sk",
)
FACT_CLAIMS = _contract(
    "fact_claims",
    _feed(
        claim_id=StringType(),
        member_sk=LongType(),
        provider_sk=LongType(),
        diagnosis_sk=LongType(),
        date_sk=LongType(),
        paid_amount=DoubleType(),
        allowed_amount=DoubleType(),
        final_procedure=StringType(),
    ),
    {"claim_id": 32, "final_procedure": 32},
)
STAR = {c.name: c for c in (DIM_MEMBER, DIM_PROVIDER, DIM_DIAGNOSIS, DIM_DATE, FACT_CLAIMS)}
