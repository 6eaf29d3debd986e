"""Raw files to star schema, on a small feed with one of each defect."""

from __future__ import annotations

import os
import random
from collections import Counter
from datetime import date
from pathlib import Path

import pytest

from clinflow.plans import stages
from clinflow.sinks.tables import Zones
from clinflow.sources.feeds import read_table

CLAIMS = """claim_id,member_id,provider_id,service_date,paid_amount,allowed_amount,icd10_code,cpt_code
C1,M1,P1,2025-01-02,10.0,12.0,i10 ,99213
C1,M1,P1,2025-01-02,10.0,12.0,,99213
C2,M1,P2,2025-01-03,20.0,25.0,,
C3,,P1,2025-01-03,5.0,6.0,I10,
C4,M2,P1,not-a-date,5.0,6.0,I10,99213
C5,M2,P1,2025-02-01,-10.0,6.0,,
C6,M9,P3,2025-02-01,7.0,8.0,UNKNOWN,36415
C7, ,P1,2025-02-01,7.0,-8.0,I10,36415
"""
PATIENTS = """patient_id,first_name,last_name,dob,zip,gender
M1,Ann,Lee,1980-05-06,02139,F
M2,Bo,Roe,1975-01-01,10001,M
"""
ENCOUNTERS = """encounter_id,patient_id,provider_id,encounter_date,diagnosis_code,procedure_code
E1,M1,P1,2025-01-01,e11.9,g0439
E2,M1,P1,2025-01-05,,80053
E2,M1,P1,2025-01-05,,80053
E3,,P1,2025-01-05,I10,80053
"""


@pytest.fixture(scope="module")
def zones(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("feed")
    (root / "claims").mkdir()
    (root / "ehr").mkdir()
    (root / "claims" / "claims.csv").write_text(CLAIMS)
    (root / "ehr" / "patients.csv").write_text(PATIENTS)
    (root / "ehr" / "encounters.csv").write_text(ENCOUNTERS)
    zones = Zones.under(str(root / "zones"))
    stages.run_all(spark, str(root / "claims"), str(root / "ehr"), zones, salt="pepper")
    return zones


def test_quality_zone(spark, zones):
    clean = read_table(spark, zones.curated("claims"))
    assert {(r.claim_id, r.icd10_code) for r in clean.collect()} == {("C1", "I10"), ("C2", None), ("C6", "UNKNOWN")}
    rejected = {r.claim_id: r.reasons for r in read_table(spark, zones.quarantine("claims")).collect()}
    assert rejected == {
        "C3": ["not_null_member_id"],
        "C4": ["not_null_service_date"],
        "C5": ["non_negative_paid_amount"],
        "C7": ["not_null_member_id", "non_negative_allowed_amount"],
    }
    texts = {r.claim_id: (r.service_date, r.service_date_text) for r in read_table(spark, zones.quarantine("claims")).collect()}
    assert texts["C4"] == (None, "not-a-date")
    assert dict(clean.dtypes)["paid_amount"] == "double" and dict(clean.dtypes)["service_date"] == "date"
    assert read_table(spark, zones.curated("encounters")).count() == 2
    assert [r.encounter_id for r in read_table(spark, zones.quarantine("encounters")).collect()] == ["E3"]
    assert read_table(spark, zones.curated("patients")).count() == 2


def test_star(spark, zones):
    model = {n: read_table(spark, zones.model(n)) for n in ("dim_member", "dim_provider", "dim_diagnosis", "dim_date", "fact_claims")}
    assert [model[n].count() for n in ("dim_member", "dim_provider", "dim_date")] == [2, 3, 3]
    codes = {r.diagnosis_sk: r.final_diagnosis for r in model["dim_diagnosis"].collect()}
    assert codes == {1: "E11.9", 2: "I10", 3: "UNKNOWN", 4: None}
    fact = [(r.claim_id, codes.get(r.diagnosis_sk), r.final_procedure, r.member_sk is None) for r in model["fact_claims"].collect()]
    assert sorted(fact, key=str) == sorted(
        [
            ("C1", "I10", "99213", False),
            ("C1", "I10", "99213", False),
            ("C2", "E11.9", "G0439", False),
            ("C2", None, "80053", False),
            ("C6", "UNKNOWN", "36415", True),
        ],
        key=str,
    )


def test_a_second_run_gives_the_same_tables(spark, zones):
    before = sorted(read_table(spark, zones.model("fact_claims")).collect(), key=str)
    stages.run_quality(spark, zones)
    stages.run_masking(spark, zones, "pepper")
    stages.run_model(spark, zones)
    assert sorted(read_table(spark, zones.model("fact_claims")).collect(), key=str) == before


def test_the_model_job_leaves_no_scratch(spark, zones):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "clinflow"
    before = set(folder.iterdir())
    stages.run_model(spark, zones, null_safe=True, missing_codes=("UNKNOWN",))
    assert set(folder.iterdir()) == before
    fact = read_table(spark, zones.model("fact_claims"))
    assert fact.filter("diagnosis_sk is null").count() == 0
    stages.run_model(spark, zones, grain="claim")
    assert read_table(spark, zones.model("fact_claims")).count() == 3
    with pytest.raises(ValueError, match="grain"):
        stages.run_model(spark, zones, grain="month")
    stages.run_model(spark, zones)


def _invented_feed(root):
    """Claims, patients and encounters with every kind of defect; returns the rows as written."""
    draw = random.Random(11)
    members = [f"M{i}" for i in range(12)]
    pick = lambda *values: draw.choice(values)
    claims = [
        [f"C{draw.randrange(60)}", pick(*members, "M99", "", " "), pick("P1", "P2", ""), pick("2025-01-02", "2025-02-03", "2025-03-04", "soon", ""),
         pick("10.5", "20", "-1", "n/a", ""), pick("11", "0", "30.25"), pick("i10", " E11 ", "UNKNOWN", "", ""), pick("99213", "", "")]
        for _ in range(150)
    ]
    visits = [
        [f"E{draw.randrange(30)}", pick(*members[:8], ""), "P1", pick("2025-01-01", "2025-02-01", "never"), pick("j45", "", "Z00"), pick("80053", "")]
        for _ in range(45)
    ]
    people = [[m, "Ann", "Lee", "1980-01-01", "02139", pick("F", "M")] for m in members]
    for name, header, rows in (
        ("claims/claims.csv", "claim_id,member_id,provider_id,service_date,paid_amount,allowed_amount,icd10_code,cpt_code", claims),
        ("ehr/encounters.csv", "encounter_id,patient_id,provider_id,encounter_date,diagnosis_code,procedure_code", visits),
        ("ehr/patients.csv", "patient_id,first_name,last_name,dob,zip,gender", people),
    ):
        path = root / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join([header, *map(",".join, rows)]) + "\n")
    return claims, people, visits


def _read(value, kind):
    """A value as the job reads it: blank is None, and so is what is no date or number."""
    value = value or None
    if value is None or kind is None:
        return value
    try:
        return kind(value)
    except ValueError:
        return None


def test_an_invented_feed_against_plain_python(spark, tmp_path):
    claims, people, visits = _invented_feed(tmp_path)
    zones = Zones.under(str(tmp_path / "zones"))
    stages.run_all(spark, str(tmp_path / "claims"), str(tmp_path / "ehr"), zones, salt="pepper")
    day, code = date.fromisoformat, lambda c: c.strip().upper()
    kinds = {"claims": [None, None, None, day, float, float, code, code], "visits": [None, None, None, day, code, code]}
    least = lambda v: (v is not None, v if v is not None else 0)
    filled = lambda v: v is not None and str(v).strip() != ""

    def curated(rows, kinds, needed, amounts, key):
        kept = {}
        for row in ([_read(v, k) for v, k in zip(r, kinds)] for r in rows):
            if all(filled(row[i]) for i in needed) and not any(row[i] is not None and row[i] < 0 for i in amounts):
                name = tuple(row[i] for i in key)
                rank = [least(v) for i, v in enumerate(row) if i not in key]
                if name not in kept or rank > kept[name][0]:
                    kept[name] = (rank, row)
        return [row for _, row in kept.values()]

    clean = curated(claims, kinds["claims"], [0, 1, 2, 3], [4, 5], (0, 3))
    seen = curated(visits, kinds["visits"], [0, 1, 3], [], (0,))
    assert read_table(spark, zones.curated("claims")).count() == len(clean)
    assert read_table(spark, zones.curated("encounters")).count() == len(seen)
    known = {p[0] for p in people}
    want = Counter()
    for claim, member, _, _, paid, allowed, icd, cpt in clean:
        met = [v for v in seen if v[1] == member and member in known]
        for v in met or [[None] * 6]:
            want[claim, paid, allowed, icd if icd is not None else v[4], cpt if cpt is not None else v[5], member in known] += 1
    codes = {r.diagnosis_sk: r.final_diagnosis for r in read_table(spark, zones.model("dim_diagnosis")).collect()}
    fact = read_table(spark, zones.model("fact_claims")).collect()
    got = Counter((r.claim_id, r.paid_amount, r.allowed_amount, codes.get(r.diagnosis_sk), r.final_procedure, r.member_sk is not None) for r in fact)
    assert got == want


@pytest.mark.skipif("SAMPLE_FEED_DIR" not in os.environ, reason="needs a folder with claims/ and ehr/ CSV files")
def test_sample_feed(spark, tmp_path):
    """Counts and sums of the public sample feed (50 claims, 20 patients, 40 encounters)."""
    source = os.environ["SAMPLE_FEED_DIR"]
    zones = Zones.under(str(tmp_path))
    stages.run_all(spark, f"{source}/claims", f"{source}/ehr", zones, salt="pepper")
    count = lambda path: read_table(spark, path).count()
    assert [count(zones.curated(n)) for n in ("claims", "patients", "encounters")] == [46, 20, 40]
    rejected = read_table(spark, zones.quarantine("claims"))
    assert {r.claim_id for r in rejected.collect()} == {"C00007", "C00011", "C00019", "C00033"}
    assert count(zones.quarantine("encounters")) == 0
    dims = ("dim_member", "dim_provider", "dim_diagnosis", "dim_date")
    assert [count(zones.model(n)) for n in dims] == [20, 10, 6, 36]
    fact = read_table(spark, zones.model("fact_claims"))
    sums = fact.selectExpr(
        "count(*)",
        "count_if(diagnosis_sk is null)",
        "count_if(final_procedure is null)",
        "count_if(member_sk is null)",
        "round(sum(paid_amount), 2)",
        "round(sum(allowed_amount), 2)",
    ).first()
    assert tuple(sums) == (95, 4, 3, 0, 23442.76, 29879.98)


OWN_FEED = {
    "claims/claims.csv": """claim_id,member_id,provider_id,service_date,paid_amount,allowed_amount,icd10_code,cpt_code
C1,M1,P1,2025-01-05,100.0,120.0,i10,99213
C2,,P1,2025-01-06,50,60,I10,
C3,M2,P2,2025-01-07,-10,20,,93000
C4,M2,P2,2025-02-01,30.5,40,,
C5,M3,P3,2025-02-02,20,25,UNKNOWN,36415
C6,M9,P1,2025-02-03,10,15,E11.9,99213
C1,M1,P1,2025-01-05,90.0,120.0,i10,99213
C8,M1,P1,not a date,5,5,I10,99213
C9,M1,P4,2025-03-01,7.25,8,,99213
""",
    "ehr/patients.csv": """patient_id,first_name,last_name,dob,zip,gender
M1,Ann,One,1980-01-01,02139,F
M2,Bob,Two,1981-02-02,10001,M
M3,Cat,Three,1982-03-03,94105,F
""",
    "ehr/encounters.csv": """encounter_id,patient_id,provider_id,encounter_date,diagnosis_code,procedure_code
E1,M1,P1,2025-01-04, j45 ,99213
E2,M1,P2,2025-02-20,,G0439
E3,M2,P2,2025-01-31,e11.9,
E4,M2,P2,2025-03-01,I10,80053
E5,,P1,2025-01-01,I10,99213
""",
}


@pytest.mark.parametrize(
    "grain, sums", [("encounter", (8, 1, 1, 1, 305.5, 376.0)), ("claim", (5, 1, 1, 1, 167.75, 208.0))]
)
def test_known_counts(spark, tmp_path, grain, sums):
    """A feed with every kind of planted defect, counted by hand: missing and unknown members, negative and repeated claims, no dates."""
    for name, text in OWN_FEED.items():
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    zones = Zones.under(str(tmp_path / "zones"))
    stages.run_all(spark, str(tmp_path / "raw/claims"), str(tmp_path / "raw/ehr"), zones, salt="pepper", grain=grain)
    table = lambda path: read_table(spark, path)
    assert [table(zones.curated(n)).count() for n in ("claims", "patients", "encounters")] == [5, 3, 4]
    assert {r.claim_id: r.reasons for r in table(zones.quarantine("claims")).collect()} == {
        "C2": ["not_null_member_id"],
        "C3": ["non_negative_paid_amount"],
        "C8": ["not_null_service_date"],
    }
    assert [r.encounter_id for r in table(zones.quarantine("encounters")).collect()] == ["E5"]
    assert [table(zones.model(n)).count() for n in ("dim_member", "dim_provider", "dim_diagnosis", "dim_date")] == [3, 4, 5, 5]
    found = table(zones.model("fact_claims")).selectExpr(
        "count(*)",
        "count_if(diagnosis_sk is null)",
        "count_if(final_procedure is null)",
        "count_if(member_sk is null)",
        "sum(paid_amount)",
        "sum(allowed_amount)",
    ).first()
    assert tuple(found) == sums
