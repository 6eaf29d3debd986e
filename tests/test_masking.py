from __future__ import annotations

from datetime import date

import pytest

from clinflow.operators import masking
from clinflow.operators.joins import JoinLimits
from clinflow.plans.stages import mask
from clinflow.schemas import CLAIMS, ENCOUNTERS, PATIENTS, PHI_COLUMNS

DAY = date(2025, 1, 1)
SALT = "pepper"


@pytest.fixture(scope="module")
def feeds(spark):
    people = [("M1", "Ann", "Lee", DAY, "02139", "F"), ("M1", "Ann", "Li", DAY, "02139", "F")]
    people += [("M2", "Bo", "Roe", DAY, "10001", "M"), (None, "No", "Id", DAY, "10001", "M")]
    claims = [("C1", "M1"), ("C2", "M2"), ("C3", "M9"), ("C4", "M1"), ("C5", None)]
    visits = [("E1", "M1"), ("E2", "M9"), ("E3", None)]
    return {
        "claims": spark.createDataFrame([(c, m, "P1", DAY, 1.0, 2.0, None, None) for c, m in claims], CLAIMS),
        "patients": spark.createDataFrame(people, PATIENTS),
        "encounters": spark.createDataFrame([(e, m, "P1", DAY, "I10", None) for e, m in visits], ENCOUNTERS),
    }


@pytest.mark.parametrize(
    "limits", [JoinLimits(), JoinLimits(broadcast_bytes=-1, hot_rows=2, sample_fraction=1.0)]
)
def test_ids_become_keys(feeds, limits):
    safe = mask(**feeds, salt=SALT, limits=limits)
    known = {row.patient_id: row.member_key for row in masking.key_mapping(feeds["patients"], SALT).table.collect()}
    assert set(known) == {"M1", "M2"}
    claims = {row.claim_id: row.member_key for row in safe["claims"].collect()}
    assert claims == {"C1": known["M1"], "C2": known["M2"], "C3": None, "C4": known["M1"], "C5": None}
    visits = {row.encounter_id: row.member_key for row in safe["encounters"].collect()}
    assert visits == {"E1": known["M1"], "E2": None, "E3": None}
    assert safe["patients"].count() == 4


def test_nothing_personal_leaves(feeds):
    safe = mask(**feeds, salt=SALT)
    forbidden = {*PHI_COLUMNS, "patient_id", "member_id"}
    raw = {"M1", "M2", "M9", "Ann", "Lee", "02139"}
    for table in safe.values():
        assert not forbidden & set(table.columns)
        for row in table.collect():
            assert not raw & {value for value in row if isinstance(value, str)}
    assert set(safe["patients"].columns) == {"gender", "member_key"}


def test_absent_personal_columns_are_ignored(spark):
    df = spark.createDataFrame([("M1", "F")], "patient_id string, gender string")
    assert masking.deidentify(df, SALT).columns == ["gender", "member_key"]
