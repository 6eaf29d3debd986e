from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from conftest import bag
from hypothesis import HealthCheck, given, settings, strategies as st

from clinflow import rules as r
from clinflow.operators import quality
from clinflow.plans.stages import curate_claims, curate_encounters
from clinflow.schemas import CLAIMS, ENCOUNTERS
from clinflow.sources.feeds import MissingColumnsError

DAY = date(2025, 1, 1)


def claim(**changes):
    row = dict(
        claim_id="C1",
        member_id="M1",
        provider_id="P1",
        service_date=DAY,
        paid_amount=10.0,
        allowed_amount=12.0,
        icd10_code="i10",
        cpt_code=" 99213",
    )
    return tuple({**row, **changes}.values())


def test_rows_with_nulls_are_rejected_once_and_leave_good(spark):
    rows = [
        claim(),
        claim(member_id=None, cpt_code=None),
        claim(member_id="  "),
        claim(paid_amount=-10.0, icd10_code=None),
        claim(member_id=None, paid_amount=-1.0, allowed_amount=-1.0),
        claim(paid_amount=None, allowed_amount=float("nan")),
    ]
    df = spark.createDataFrame(rows, CLAIMS)
    good, bad = quality.apply_rules(df, r.DEFAULT_RULES.claims, "claims_dq_failed")
    assert good.count() == 2
    assert {row.reason for row in bad.collect()} == {"claims_dq_failed"}
    assert sorted(tuple(row.reasons) for row in bad.collect()) == sorted(
        [
            ("not_null_member_id",),
            ("not_null_member_id",),
            ("non_negative_paid_amount",),
            ("not_null_member_id", "non_negative_paid_amount", "non_negative_allowed_amount"),
        ]
    )
    summary = quality.dq_summary(df, r.DEFAULT_RULES.claims).first()
    assert (summary.rows_in, summary.rows_good, summary.rows_bad) == (6, 2, 4)
    assert summary.failed_not_null_member_id == 3
    assert summary.failed_non_negative_paid_amount == 2


text = st.one_of(st.none(), st.sampled_from(["", " ", "a", "b"]))
amount = st.one_of(st.none(), st.sampled_from([-1.0, -0.0, 0.0, 2.0, float("nan")]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(text, text, amount), max_size=30))
def test_good_and_bad_are_the_input(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, x double")
    good, bad = quality.split_rows(df, r.not_null(["a"]) + r.non_negative(["x"]))
    assert bag(good) + bag(bad) == bag(df)
    for row in good.collect():
        assert row.a and row.a.strip() and not (row.x is not None and row.x < 0)


def test_no_rules_means_all_good_and_an_empty_bad_frame(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    good, bad = quality.apply_rules(df, [], "none")
    assert good.count() == 1 and bad.count() == 0
    assert bad.columns == ["a", "b", "reason", "reasons"]
    assert quality.dq_summary(df, []).first().asDict() == {"rows_in": 1, "rows_good": 1, "rows_bad": 0}


def test_absent_columns(spark):
    df = spark.createDataFrame([("a",)], "a string")
    with pytest.raises(MissingColumnsError, match="b, c"):
        quality.split_rows(df, r.not_null(["a", "b", "c"]))
    good, bad = quality.split_rows(df, r.not_null(["a"]) + r.non_negative(["x"]))
    assert (good.count(), bad.count()) == (1, 0)
    assert quality.standardize_codes(df, ["x"]).columns == ["a"]


def test_dates_from_any_type(spark):
    df = spark.createDataFrame(
        [("2025-01-01", DAY, datetime(2025, 1, 1, 23, 59)), ("never", None, None)], "t string, d date, s timestamp_ntz"
    )
    first, second = quality.normalize_dates(df, ["t", "d", "s"]).collect()
    assert tuple(first) == (DAY, DAY, DAY)
    assert tuple(second) == (None, None, None)


def test_curated_claims(spark):
    rows = [
        claim(paid_amount=10.0),
        claim(paid_amount=11.0, icd10_code=None),
        claim(paid_amount=11.0),
        claim(service_date=None),
        claim(claim_id="C2", icd10_code=" e11.9 "),
    ]
    clean, quarantine = curate_claims(spark.createDataFrame(rows, CLAIMS))
    got = {(row.claim_id, row.paid_amount, row.icd10_code, row.cpt_code) for row in clean.collect()}
    assert got == {("C1", 11.0, "I10", "99213"), ("C2", 10.0, "E11.9", "99213")}
    assert clean.columns == CLAIMS.names
    assert [row.reasons for row in quarantine.collect()] == [["not_null_service_date"]]


def test_an_unreadable_date_ends_in_quarantine(spark):
    as_text = spark.createDataFrame([("E1", "M1", "P1", "31/01/2025", None, None)], "encounter_id string, patient_id string, provider_id string, encounter_date string, diagnosis_code string, procedure_code string")
    clean, quarantine = curate_encounters(as_text)
    assert clean.count() == 0 and clean.columns == ENCOUNTERS.names
    assert [row.reasons for row in quarantine.collect()] == [["not_null_encounter_date"]]


def test_rule_file(spark, tmp_path):
    settings_ = {
        "dq_rules": {"claims": {"not_null": ["a"], "non_negative": ["x"]}, "ehr": {}},
        "standardization": {"uppercase_cols": ["code"]},
    }
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(settings_, indent=2))
    loaded = r.load_rules(spark, str(path))
    assert [rule.name for rule in loaded.claims] == ["not_null_a", "non_negative_x"]
    assert loaded.encounters == [] and loaded.code_columns == ("code",)


def test_misspelt_rules_are_refused():
    with pytest.raises(ValueError, match="no rules for feed: ehr"):
        r.RuleSet.from_mapping({"dq_rules": {"claims": {}}})
    with pytest.raises(ValueError, match="nonnegative"):
        r.RuleSet.from_mapping({"dq_rules": {"claims": {"nonnegative": ["x"]}, "ehr": {}}})
