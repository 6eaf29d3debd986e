from __future__ import annotations

from collections import Counter
from datetime import date, timedelta

import pytest
from conftest import bag
from pyspark.sql import functions as F

from clinflow.operators import integrate as i, star
from clinflow.operators.joins import JoinLimits

DAY = date(2025, 1, 1)
SMALL = JoinLimits()
PLAIN = JoinLimits(broadcast_bytes=-1, hot_rows=10_000, sample_fraction=1.0)
HOT = JoinLimits(broadcast_bytes=-1, hot_rows=3, sample_fraction=1.0)

# (claim, member, provider, day, icd10, cpt): one member with most claims, some without a key or a code.
CLAIM_ROWS = [(f"C{n}", "m1", f"P{n % 3}", n % 4, "I10" if n % 3 else None, None if n % 5 else "A") for n in range(20)]
CLAIM_ROWS += [("C90", None, "P1", 1, None, "B"), ("C91", None, "P1", 1, None, None), ("C92", None, "P2", 0, "E11", None)]
CLAIM_ROWS += [("C93", "m3", "P9", 2, None, None), ("C94", "m2", "P9", 2, "UNKNOWN", None), ("C95", "m4", "P9", None, None, None)]
# (member, diagnosis, procedure, day): one member with many equal encounters, one without claims.
VISIT_ROWS = [("m1", "J45", "X", 1)] * 7 + [("m1", None, "Y", 2), ("m1", "Z00", None, 3)]
VISIT_ROWS += [("m2", "E11", "X", n) for n in range(6)] + [("m9", "R99", "X", 1), (None, "Q00", "X", 1), ("m4", None, None, 0)]


def day(n):
    return None if n is None else DAY + timedelta(days=n)


@pytest.fixture(scope="module")
def safe(spark):
    claims = [(c, p, day(d), float(n), n + 1.0, icd, cpt, m) for n, (c, m, p, d, icd, cpt) in enumerate(CLAIM_ROWS)]
    visits = [(f"E{n}", "P1", day(d), dx, px, m) for n, (m, dx, px, d) in enumerate(VISIT_ROWS)]
    people = [("F", "m1"), ("M", "m2"), ("F", "m3"), ("F", "m4")]
    return {
        "claims": spark.createDataFrame(
            claims,
            "claim_id string, provider_id string, service_date date, paid_amount double, allowed_amount double, "
            "icd10_code string, cpt_code string, member_key string",
        ),
        "patients": spark.createDataFrame(people, "gender string, member_key string"),
        "encounters": spark.createDataFrame(
            visits,
            "encounter_id string, provider_id string, encounter_date date, diagnosis_code string, "
            "procedure_code string, member_key string",
        ),
    }


def pairs():
    for n, (claim, member, provider, d, icd, cpt) in enumerate(CLAIM_ROWS):
        met = [v for v in VISIT_ROWS if v[0] == member and member is not None]
        for _, dx, px, visit_day in met or [(None, None, None, None)]:
            yield n, claim, member, provider, d, icd, cpt, dx, px, visit_day


@pytest.mark.parametrize("limits", [SMALL, PLAIN, HOT])
def test_integrated_rows_are_claims_times_encounters(safe, limits):
    got = i.integrate(safe["claims"], safe["encounters"], limits=limits)
    columns = ["claim_id", "diagnosis_code", "procedure_code", "encounter_date", "final_diagnosis", "final_procedure"]
    want = Counter(
        tuple(map(repr, (claim, dx, px, day(vd), icd if icd is not None else dx, cpt if cpt is not None else px)))
        for _, claim, _, _, _, icd, cpt, dx, px, vd in pairs()
    )
    assert Counter(tuple(map(repr, row)) for row in got.select(columns).collect()) == want
    assert set(got.columns) == {*safe["claims"].columns, *columns}


@pytest.mark.parametrize("limits", [SMALL, PLAIN, HOT])
@pytest.mark.parametrize("null_safe", [False, True])
def test_fact(safe, limits, null_safe):
    visits = star.fold_visits(safe["encounters"])
    dims = star.build_dims(safe["claims"], safe["patients"], visits)
    fact = star.build_fact(safe["claims"], visits, dims, limits=limits, null_safe=null_safe)
    assert fact.columns == [
        "claim_id",
        "member_sk",
        "provider_sk",
        "diagnosis_sk",
        "date_sk",
        "paid_amount",
        "allowed_amount",
        "final_procedure",
    ]

    def ranks(values):
        known = sorted({v for v in values if v is not None})
        return {v: n for n, v in enumerate(known, start=1)} | {None: None}

    member = ranks(["m1", "m2", "m3", "m4"])
    provider = ranks([row[2] for row in CLAIM_ROWS])
    dates = ranks([row[3] for row in CLAIM_ROWS])
    final = [icd if icd is not None else dx for _, _, _, _, _, icd, _, dx, _, _ in pairs()]
    diagnosis = ranks(final)
    if null_safe:
        diagnosis[None] = len(diagnosis)
    want = Counter(
        (claim, member[m], provider[p], diagnosis[icd if icd is not None else dx], dates[d], float(n), n + 1.0, cpt if cpt is not None else px)
        for n, claim, m, p, d, icd, cpt, dx, px, _ in pairs()
    )
    assert Counter(map(tuple, fact.collect())) == want


def test_diagnoses_without_integrating(safe):
    integrated = i.integrate(safe["claims"], safe["encounters"])
    want = {row[0] for row in integrated.select("final_diagnosis").distinct().collect()}
    assert {row[0] for row in star.dim_diagnosis(safe["claims"], safe["encounters"]).collect()} == want
    strict = i.integrate(safe["claims"], safe["encounters"], missing_codes=("UNKNOWN",))
    want = {row[0] for row in strict.select("final_diagnosis").distinct().collect()}
    assert "UNKNOWN" not in want
    dim = star.dim_diagnosis(safe["claims"], safe["encounters"], missing_codes=("UNKNOWN",))
    assert {row.final_diagnosis for row in dim.collect()} == want


def test_every_fact_key_is_in_its_dimension(safe):
    visits = star.fold_visits(safe["encounters"])
    dims = star.build_dims(safe["claims"], safe["patients"], visits)
    fact = star.build_fact(safe["claims"], visits, dims)
    for name, key in (("dim_member", "member_sk"), ("dim_provider", "provider_sk"), ("dim_diagnosis", "diagnosis_sk"), ("dim_date", "date_sk")):
        used = fact.filter(F.col(key).isNotNull()).select(key).distinct()
        assert used.join(dims[name], key, "left_anti").count() == 0


def test_many_copies_are_cut_into_pieces(spark):
    visits = spark.createDataFrame([("m", "x")] * 10 + [("m", None), (None, "x")], "member_key string, code string")
    folded = i.fold_encounters(visits, ["code"], max_copies=4)
    assert sorted(row.copies for row in folded.filter("code = 'x'").collect()) == [2, 4, 4]
    whole = i.expand_copies(folded)
    assert bag(whole) == bag(visits.filter("member_key is not null"))
