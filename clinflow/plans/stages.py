"""The stages from raw feeds to the star schema, each reading and writing zone tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from clinflow.operators.incremental import extend_registry, lacking
from clinflow.operators.joins import DEFAULT_LIMITS, JoinLimits
from clinflow.operators.masking import deidentify, key_mapping, replace_id
from clinflow.operators.quality import apply_rules, normalize_dates, standardize_codes, text_columns, with_types
from clinflow.operators.rows import keep_one
from clinflow.operators.star import (
    build_dims,
    build_fact,
    build_fact_by_claim,
    dates_of,
    dim_rows,
    final_diagnoses,
    fold_visits,
    known_members,
    with_calendar,
)
from clinflow.rules import DEFAULT_RULES, RuleSet
from clinflow.schemas import (
    CLAIM_KEY,
    CLAIMS,
    CLAIMS_REASON,
    EHR_REASON,
    ENCOUNTER_KEY,
    ENCOUNTERS,
    PATIENTS,
    TableContract,
)
from clinflow.scratch import exists, job_folder, materialize, side_by_side
from clinflow.sinks.tables import Zones, write_table
from clinflow.sinks.warehouse import JdbcTarget, load_table
from clinflow.sources.feeds import read_feed, read_table


def ingest_claims(spark: SparkSession, source: str, zones: Zones) -> None:
    write_table(read_feed(spark, source, CLAIMS, required=CLAIMS.names), zones.staging("claims"))


def ingest_ehr(spark: SparkSession, source: str, zones: Zones) -> None:
    """``source`` holds patients.csv and encounters.csv."""
    for name, schema in (("patients", PATIENTS), ("encounters", ENCOUNTERS)):
        write_table(read_feed(spark, f"{source.rstrip('/')}/{name}.csv", schema), zones.staging(name))


# The text of a date or amount lies beside its value in quarantine.
TEXT = "_text"


def _curate(df, schema, dates, rules, codes, reason, key) -> tuple[DataFrame, DataFrame]:
    texts = [name + TEXT for name in text_columns(df, schema)]
    tidy = standardize_codes(normalize_dates(with_types(df, schema, TEXT), dates), codes)
    good, quarantine = apply_rules(tidy, rules, reason)
    return keep_one(good.drop(*texts), key), quarantine


def curate_claims(claims: DataFrame, rules: RuleSet = DEFAULT_RULES) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine) of a claims feed, typed or as text; of text, quarantine also keeps what was written."""
    return _curate(claims, CLAIMS, ["service_date"], rules.claims, rules.code_columns, CLAIMS_REASON, CLAIM_KEY)


def curate_encounters(encounters: DataFrame, rules: RuleSet = DEFAULT_RULES) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine) of an encounters feed, typed or as text; of text, quarantine also keeps what was written."""
    return _curate(
        encounters, ENCOUNTERS, ["encounter_date"], rules.encounters, rules.code_columns, EHR_REASON, ENCOUNTER_KEY
    )


def run_quality(spark: SparkSession, zones: Zones, rules: RuleSet = DEFAULT_RULES) -> None:
    """Staging to curated and quarantine; patients only get their types.

    The two sides of a split are two scans of staging: both are narrow up to the dedup, and a second
    read of columnar files costs less than caching a whole feed.
    """
    write_table(with_types(read_table(spark, zones.staging("patients")), PATIENTS), zones.curated("patients"))
    for name, curate in (("claims", curate_claims), ("encounters", curate_encounters)):
        clean, quarantine = curate(read_table(spark, zones.staging(name)), rules)
        write_table(clean, zones.curated(name))
        write_table(quarantine, zones.quarantine(name))


def mask(
    claims: DataFrame,
    patients: DataFrame,
    encounters: DataFrame,
    salt: str,
    limits: JoinLimits = DEFAULT_LIMITS,
    keys_from: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The three curated tables without identifiers or personal columns, linked by ``member_key``.

    Claims and encounters that are not stored but still to be computed are better not read twice:
    ``keys_from`` may name stored tables with the same identifiers in which to look for hot ones.
    """
    mapping = key_mapping(patients, salt, limits=limits)

    def masked(name: str, df: DataFrame, id_column: str, row_key: Sequence[str]) -> DataFrame:
        stored = (keys_from or {}).get(name)
        return replace_id(df, id_column, mapping, spread_by=row_key, keys_from=stored, limits=limits)

    return {
        "claims": masked("claims", claims, "member_id", CLAIM_KEY),
        "patients": deidentify(patients, salt),
        "encounters": masked("encounters", encounters, "patient_id", ENCOUNTER_KEY),
    }


def run_masking(spark: SparkSession, zones: Zones, salt: str, limits: JoinLimits = DEFAULT_LIMITS) -> None:
    """Curated to safe. ``salt`` is required and should come from a secret store."""
    curated = {name: read_table(spark, zones.curated(name)) for name in ("claims", "patients", "encounters")}
    for name, table in mask(**curated, salt=salt, limits=limits).items():
        write_table(table, zones.safe(name))


def run_model(
    spark: SparkSession,
    zones: Zones,
    missing_codes: Sequence[str] = (),
    limits: JoinLimits = DEFAULT_LIMITS,
    null_safe: bool = False,
    grain: str = "encounter",
) -> None:
    """Safe to star schema. The fact reads the written dimensions, so its keys are the stored ones.

    ``grain`` is what a row of the fact stands for: "encounter", a claim and an encounter of its member, or
    "claim", with the codes of the nearest encounter. ``null_safe`` refers facts without a diagnosis to the
    NULL row of its dimension. What the job keeps meanwhile is gone at its end.
    """
    if grain not in ("encounter", "claim"):
        raise ValueError(f"unknown grain: {grain}")
    claims, patients, encounters = (
        read_table(spark, zones.safe(name)) for name in ("claims", "patients", "encounters")
    )
    with job_folder(spark, "model"):
        visits = fold_visits(encounters)
        for name, dim in build_dims(claims, patients, visits, missing_codes).items():
            write_table(dim, zones.model(name))
        dims = {
            name: read_table(spark, zones.model(name))
            for name in ("dim_member", "dim_provider", "dim_diagnosis", "dim_date")
        }
        if grain == "claim":
            fact = build_fact_by_claim(claims, encounters, dims, missing_codes, null_safe, limits)
        else:
            fact = build_fact(claims, visits, dims, missing_codes, null_safe, limits)
        write_table(fact, zones.model("fact_claims"))


def _loaded_claims(spark: SparkSession, claims: DataFrame, zones: Zones) -> DataFrame:
    """CLAIM_KEY of the fact's claims that share a day with ``claims``; days repeat, so both lists of days are small.

    Numbers of days rise from run to run, so the range of those asked for lets the scan pass over files of other days.
    """
    fact = read_table(spark, zones.model("fact_claims")).select("claim_id", "date_sk")
    days = claims.select(F.col("service_date").alias("date")).distinct()
    # At most one row a day of the calendar.
    dates = read_table(spark, zones.model("dim_date")).join(F.broadcast(days), "date", "left_semi")
    ends = Observation()
    seen = dates.observe(ends, F.min("date_sk").alias("least"), F.max("date_sk").alias("greatest"))
    dates = materialize(seen.select("date_sk", F.col("date").alias("service_date")), "days")
    asked = F.col("date_sk").between(ends.get.get("least"), ends.get.get("greatest"))
    dated = fact.filter(asked).join(F.broadcast(dates), "date_sk")
    undated = fact.filter(F.col("date_sk").isNull()).withColumn("service_date", F.lit(None).cast("date"))
    return dated.select(*CLAIM_KEY).unionByName(undated.select(*CLAIM_KEY))


def run_daily(
    spark: SparkSession,
    claims: DataFrame,
    patients: DataFrame,
    encounters: DataFrame,
    zones: Zones,
    missing_codes: Sequence[str] = (),
    limits: JoinLimits = DEFAULT_LIMITS,
    null_safe: bool = False,
    grain: str = "encounter",
) -> None:
    """Safe tables of a day, which may hold earlier days again, added to the star schema that the zones hold.

    Keys given before stay as they are; new members, providers, diagnoses and dates follow. Claims that the fact has are
    left out, whatever their encounters are now, so running a day again adds nothing.
    """
    with job_folder(spark, "daily"):
        claims = materialize(claims, "claims")
        fact_path = zones.model("fact_claims")
        if exists(spark, fact_path):
            loaded = _loaded_claims(spark, claims, zones)
            claims = materialize(lacking(claims, loaded, CLAIM_KEY, limits), "new-claims")
        # One row per claim needs no folded encounters.
        visits = encounters if grain == "claim" else fold_visits(encounters)

        def registry(name: str, rows: DataFrame, natural: str, key: str) -> DataFrame:
            return extend_registry(spark, zones.model(name), rows, [natural], key, limits=limits)

        members = dim_rows(known_members(patients), ["member_key", "gender"])
        dims = side_by_side(
            {
                "dim_member": lambda: registry("dim_member", members, "member_key", "member_sk"),
                "dim_provider": lambda: registry("dim_provider", dim_rows(claims, ["provider_id"]), "provider_id", "provider_sk"),
                "dim_diagnosis": lambda: registry(
                    "dim_diagnosis", final_diagnoses(claims, visits, missing_codes).distinct(), "final_diagnosis", "diagnosis_sk"
                ),
                "dim_date": lambda: with_calendar(registry("dim_date", dates_of(claims, "service_date").distinct(), "date", "date_sk")),
            }
        )
        if grain == "claim":
            fact = build_fact_by_claim(claims, encounters, dims, missing_codes, null_safe, limits)
        else:
            fact = build_fact(claims, visits, dims, missing_codes, null_safe, limits)
        fact.write.mode("append").parquet(fact_path)


def load_to_warehouse(spark: SparkSession, path: str, contract: TableContract, target: JdbcTarget) -> None:
    """One parquet table to one warehouse table."""
    load_table(read_table(spark, path), contract, target)


def run_all(
    spark: SparkSession,
    claims_source: str,
    ehr_source: str,
    zones: Zones,
    salt: str,
    rules: RuleSet = DEFAULT_RULES,
    limits: JoinLimits = DEFAULT_LIMITS,
    missing_codes: Sequence[str] = (),
    null_safe: bool = False,
    grain: str = "encounter",
) -> None:
    """Raw feeds to star schema, stage by stage; a failed run can restart at any stage from its zone."""
    ingest_claims(spark, claims_source, zones)
    ingest_ehr(spark, ehr_source, zones)
    run_quality(spark, zones, rules)
    run_masking(spark, zones, salt, limits)
    run_model(spark, zones, missing_codes, limits, null_safe, grain)
