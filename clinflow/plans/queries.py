"""Every operator as a query over the given tables: name -> f(spark, folder) -> DataFrame."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinflow import rules as r
from clinflow.functions import columns as c
from clinflow.operators import (
    asof,
    contract,
    episodes,
    incremental,
    integrate,
    intervals,
    joins,
    masking,
    quality,
    rollup,
    rows,
    sketches,
    star,
    top,
)
from clinflow.operators.joins import DEFAULT_LIMITS, JoinLimits
from clinflow.plans import stages
from clinflow.schemas import CLAIM_KEY, CLAIMS, CLAIMS_REASON, DIM_MEMBER, STAR
from clinflow.scratch import materialize, new_path, side_by_side
from clinflow.sinks import partitioned
from clinflow.sinks.tables import Zones, write_table
from clinflow.sources import profile, views
from clinflow.sources.feeds import read_feed, read_table
from clinflow.streaming import episodes as episode_stream, quality as quality_stream

Query = Callable[[SparkSession, str], DataFrame]

# The oracle has to hash with the same salt. Real runs pass their own.
SALT = "oracle-check"

REGISTERED: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTERED[run.__name__] = run
    return run


def _safe(spark: SparkSession, folder: str, encounters: Callable = views.encounters) -> dict[str, DataFrame]:
    """Curated and de-identified claims, patients and encounters."""
    raw = {"claims": views.claims(spark, folder), "encounters": encounters(spark, folder)}
    clean_claims, _ = stages.curate_claims(raw["claims"])
    clean_encounters, _ = stages.curate_encounters(raw["encounters"])
    return stages.mask(clean_claims, views.patients_with_gaps(spark, folder), clean_encounters, SALT, keys_from=raw)


def _star(
    spark: SparkSession, folder: str, limits: JoinLimits = DEFAULT_LIMITS, null_safe: bool = False
) -> dict[str, DataFrame]:
    """Dimensions and fact, from written claims and visits as in the stored zones."""
    safe = _safe(spark, folder)
    stored = side_by_side(
        {
            "claims": lambda: materialize(safe["claims"], "safe-claims"),
            "visits": lambda: star.fold_visits(safe["encounters"]),
        }
    )
    claims, visits = stored["claims"], stored["visits"]
    dims = star.build_dims(claims, safe["patients"], visits)
    return {**dims, "fact_claims": star.build_fact(claims, visits, dims, null_safe=null_safe, limits=limits)}


# Limits so low that every side is too large to broadcast and every frequent key hot.
SPREAD = JoinLimits(broadcast_bytes=-1, hot_rows=20, sample_fraction=1.0)


def _write_feed(df: DataFrame, path: str) -> None:
    """One folder of headed CSV, the header in capitals, values as they are."""
    loud = df.toDF(*[name.upper() for name in df.columns])
    loud.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


# The default rules as a file, but for one: that the file is read shows by allowed amounts not being checked.
RULES = r.RuleSet(
    [rule for rule in r.DEFAULT_RULES.claims if rule.name != "non_negative_allowed_amount"],
    r.DEFAULT_RULES.encounters,
    r.DEFAULT_RULES.code_columns,
).as_mapping()


def _zones(spark: SparkSession, folder: str) -> Zones:
    """The given tables as CSV feeds, and the whole way to the star schema by the job functions users call."""
    root = new_path(spark, "jobs")
    _write_feed(views.feed_claims(spark, folder), f"{root}/raw/claims")
    _write_feed(views.patients_with_gaps(spark, folder), f"{root}/raw/ehr/patients.csv")
    _write_feed(views.encounters(spark, folder), f"{root}/raw/ehr/encounters.csv")
    spark.createDataFrame([(json.dumps(RULES),)], "value string").coalesce(1).write.text(f"{root}/rules")
    zones = Zones.under(f"{root}/zones")
    stages.run_all(spark, f"{root}/raw/claims", f"{root}/raw/ehr", zones, SALT, r.load_rules(spark, f"{root}/rules"))
    return zones


# --- sources and sinks ---


@query
def scan_parquet(spark, folder):
    return read_table(spark, f"{folder}/orders.parquet")


@query
def parquet_roundtrip(spark, folder):
    path = new_path(spark, "roundtrip")
    write_table(views.claims(spark, folder), path)
    return read_table(spark, path)


@query
def csv_claims(spark, folder):
    """Claims written as text with a header in capitals and read back; unreadable values keep their text."""
    path = new_path(spark, "feed")
    _write_feed(views.feed_claims(spark, folder), path)
    feed = read_feed(spark, path, CLAIMS, required=CLAIMS.names)
    typed = quality.with_types(feed, CLAIMS, "_text")
    unread = F.col("paid_amount").isNull() & F.col("paid_amount_text").isNotNull()
    return typed.withColumn("paid_unread", unread).drop("paid_amount_text", "allowed_amount_text")


@query
def csv_unread_values(spark, folder):
    return quality.unread_values(views.feed_claims(spark, folder), CLAIMS)


@query
def pipeline_quarantine(spark, folder):
    found = read_table(spark, _zones(spark, folder).quarantine("claims"))
    return found.drop("paid_amount_text", "allowed_amount_text").withColumn("reasons", F.array_join("reasons", ","))


@query
def pipeline_safe_claims(spark, folder):
    return read_table(spark, _zones(spark, folder).safe("claims"))


@query
def pipeline_fact(spark, folder):
    return read_table(spark, _zones(spark, folder).model("fact_claims"))


@query
def contract_violations(spark, folder):
    """Raw claims offered as a member dimension break every kind of check."""
    offered = views.claims(spark, folder).select(
        F.col("claim_id").cast("long").alias("claim"),
        F.col("provider_id").cast("long").alias("member_sk"),
        F.col("member_id").alias("member_key"),
        F.col("cpt_code").alias("gender"),
    )
    return contract.contract_violations(offered, DIM_MEMBER)


@query
def contract_star(spark, folder):
    """The built star schema against its own contract."""
    tables = _star(spark, folder)
    return rows.union_rows(*[contract.contract_violations(tables[name], STAR[name]) for name in STAR])


# --- projections and filters ---


@query
def project_columns(spark, folder):
    return views.claims(spark, folder).select("claim_id", "paid_amount", "allowed_amount")


@query
def project_rename(spark, folder):
    return views.patients(spark, folder).select(F.col("patient_id").alias("member_id"), "gender")


@query
def derive_column(spark, folder):
    claims = views.claims(spark, folder)
    return claims.withColumns(c.calendar_parts(F.col("service_date")))


@query
def drop_columns(spark, folder):
    return views.encounters(spark, folder).drop("patient_id", "provider_id", "no_such_column")


@query
def filter_null_or_blank(spark, folder):
    return views.claims(spark, folder).filter(~c.is_filled(F.col("member_id")))


@query
def filter_negative(spark, folder):
    return views.table(spark, folder, "customer").filter(c.is_negative(F.col("c_acctbal")))


@query
def filter_not_null(spark, folder):
    return views.claims(spark, folder).select("service_date").filter(F.col("service_date").isNotNull())


# --- scalar functions ---


@query
def scalar_standardize(spark, folder):
    return views.claims(spark, folder).select("claim_id", c.clean_code(F.col("icd10_code")).alias("code"))


@query
def scalar_dates(spark, folder):
    """Dates read from text, every thirteenth of them no date at all."""
    text = F.date_format("service_date", "yyyy-MM-dd")
    broken = F.col("claim_id").cast("long") % 13 == 0
    offered = views.claims(spark, folder).select(
        "claim_id", F.when(broken, F.concat(text, F.lit("?"))).otherwise(text).alias("text")
    )
    day = c.as_date(F.col("text"))
    parts = [part.alias(name) for name, part in c.calendar_parts(day).items()]
    return offered.select("claim_id", day.alias("day_read"), *parts)


@query
def scalar_cast(spark, folder):
    """Codes and ids read as amounts; most codes are no number."""
    return views.claims(spark, folder).select(
        "claim_id",
        c.as_amount(F.col("member_id")).alias("member_number"),
        c.as_amount(F.col("cpt_code")).alias("code_number"),
    )


@query
def scalar_hash(spark, folder):
    return views.claims(spark, folder).select(
        "claim_id", F.sha2(F.concat_ws("||", "member_id", F.lit(SALT)), 256).alias("digest")
    )


@query
def scalar_coalesce(spark, folder):
    return views.claims(spark, folder).select(
        "claim_id", c.first_code(F.col("icd10_code"), F.col("cpt_code")).alias("code")
    )


@query
def member_key(spark, folder):
    claims = views.claims(spark, folder)
    return claims.select("claim_id", c.member_key(F.col("member_id"), SALT).alias("member_key"))


# --- set operators and dedup ---


@query
def distinct_rows(spark, folder):
    lines = views.repeated_lines(spark, folder)
    return lines.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query
def dedup_lines(spark, folder):
    return rows.keep_one(views.repeated_lines(spark, folder), ["l_orderkey", "l_linenumber"])


@query
def dedup_claims(spark, folder):
    """Claims sent twice, the second time with another amount."""
    claims = views.claims(spark, folder)
    resent = claims.withColumn("paid_amount", F.col("paid_amount") + 1)
    return rows.keep_one(rows.union_rows(claims, resent), ["claim_id", "service_date"])


@query
def dedup_encounters(spark, folder):
    """Encounters sent twice, the second time without their procedure."""
    encounters = views.encounters(spark, folder)
    resent = encounters.withColumn("procedure_code", F.lit(None).cast("string"))
    return rows.keep_one(rows.union_rows(encounters, resent), ["encounter_id"])


@query
def union_by_name(spark, folder):
    claims = views.claims(spark, folder).select("member_id", "provider_id")
    encounters = views.encounters(spark, folder)
    return rows.union_rows(claims, encounters.select("provider_id", F.col("patient_id").alias("member_id")))


@query
def except_rows(spark, folder):
    """Code pairs of claims that no negative claim has."""
    claims = views.claims(spark, folder)
    negative = claims.filter(c.is_negative(F.col("paid_amount")))
    return rows.except_rows(
        claims.select("icd10_code", "cpt_code", "provider_id"),
        negative.select("icd10_code", "cpt_code", "provider_id"),
    )


@query
def join_left_anti(spark, folder):
    """Claims of members without any encounter."""
    seen = views.encounters(spark, folder).select(F.col("patient_id").alias("member_id"))
    return joins.anti_join(views.claims(spark, folder), seen, "member_id")


# --- quality ---


@query
def standardize_codes(spark, folder):
    return quality.standardize_codes(views.claims(spark, folder), r.DEFAULT_RULES.code_columns)


@query
def normalize_dates(spark, folder):
    """Dates that arrive as text, some with a suffix that makes them no date."""
    text = F.date_format("encounter_date", "yyyy-MM-dd")
    broken = F.col("encounter_id").cast("long") % 17 == 0
    offered = views.encounters(spark, folder).withColumn(
        "encounter_date", F.when(broken, F.concat(F.lit("on "), text)).otherwise(text)
    )
    return quality.normalize_dates(offered, ["encounter_date"])


_FILLED = r.not_null(["claim_id", "member_id", "provider_id", "service_date"])
_AMOUNTS = r.non_negative(["paid_amount", "allowed_amount"])


@query
def dq_not_null_good(spark, folder):
    return quality.split_rows(views.claims(spark, folder), _FILLED)[0]


@query
def dq_not_null_bad(spark, folder):
    return quality.split_rows(views.claims(spark, folder), _FILLED)[1]


@query
def dq_non_negative_good(spark, folder):
    return quality.split_rows(views.claims(spark, folder), _AMOUNTS)[0]


@query
def dq_non_negative_bad(spark, folder):
    return quality.split_rows(views.claims(spark, folder), _AMOUNTS)[1]


@query
def dq_claims_good(spark, folder):
    return quality.split_rows(views.claims(spark, folder), r.DEFAULT_RULES.claims)[0]


@query
def dq_encounters_good(spark, folder):
    return quality.split_rows(views.encounters_with_gaps(spark, folder), r.DEFAULT_RULES.encounters)[0]


@query
def dq_claims_quarantine(spark, folder):
    _, bad = quality.apply_rules(views.claims(spark, folder), r.DEFAULT_RULES.claims, CLAIMS_REASON)
    return bad.withColumn("reasons", F.array_join("reasons", ","))


@query
def dq_encounters_quarantine(spark, folder):
    _, bad = stages.curate_encounters(views.encounters_with_gaps(spark, folder))
    return bad.withColumn("reasons", F.array_join("reasons", ","))


@query
def dq_summary(spark, folder):
    return quality.dq_summary(views.claims(spark, folder), r.DEFAULT_RULES.claims)


@query
def curate_claims(spark, folder):
    return stages.curate_claims(views.claims(spark, folder))[0]


@query
def curate_encounters(spark, folder):
    return stages.curate_encounters(views.encounters_with_gaps(spark, folder))[0]


@query
def split_no_rules(spark, folder):
    """Without rules every row is good, and the rejected side is an empty frame."""
    good, bad = quality.split_rows(views.claims(spark, folder), [])
    return rows.union_rows(good, bad)


@query
def rules_on_absent_column(spark, folder):
    """A rule on the sign of a column that is not there falls away; the others hold."""
    claims = views.claims(spark, folder).drop("allowed_amount")
    return quality.split_rows(claims, r.DEFAULT_RULES.claims)[0]


# --- masking ---


@query
def deidentify_patients(spark, folder):
    return masking.deidentify(views.patients(spark, folder), SALT)


@query
def mask_claims(spark, folder):
    mapping = masking.key_mapping(views.patients(spark, folder), SALT)
    return masking.replace_id(views.claims_with_strangers(spark, folder), "member_id", mapping)


@query
def mask_encounters(spark, folder):
    mapping = masking.key_mapping(views.patients(spark, folder), SALT)
    return masking.replace_id(views.encounters_with_gaps(spark, folder), "patient_id", mapping)


# --- star schema ---


@query
def integrate_claims(spark, folder):
    safe = _safe(spark, folder)
    claims, encounters = (materialize(safe[name], f"safe-{name}") for name in ("claims", "encounters"))
    return integrate.integrate(claims, encounters)


@query
def dim_member(spark, folder):
    return star.dim_member(masking.deidentify(views.patients_with_gaps(spark, folder), SALT))


@query
def dim_member_ranges(spark, folder):
    """Numbered in many ranges instead of one window."""
    return star.dim_member(masking.deidentify(views.patients_with_gaps(spark, folder), SALT), rows_per_task=100)


@query
def dim_two_columns(spark, folder):
    """A natural key of two columns; the others are those of its least row."""
    patients = views.patients_with_gaps(spark, folder)
    return star.build_dim(patients, ["zip", "gender", "last_name", "first_name"], "patient_group_sk", natural=2)


def _curated_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Masking changes members alone, so providers and dates need not wait for it."""
    return stages.curate_claims(views.claims(spark, folder))[0]


@query
def dim_provider(spark, folder):
    return star.dim_provider(_curated_claims(spark, folder))


@query
def dim_diagnosis(spark, folder):
    safe = _safe(spark, folder)
    return star.dim_diagnosis(safe["claims"], safe["encounters"])


@query
def dim_date(spark, folder):
    return star.dim_date(_curated_claims(spark, folder))


@query
def lookup_member(spark, folder):
    safe = _safe(spark, folder)
    claims = safe["claims"].select("claim_id", "member_key")
    return star.add_member_sk(claims, star.dim_member(safe["patients"]))


@query
def lookup_provider(spark, folder):
    claims = materialize(_safe(spark, folder)["claims"], "safe-claims")
    return star.add_provider_sk(claims.select("claim_id", "provider_id"), star.dim_provider(claims))


@query
def lookup_diagnosis(spark, folder):
    """The claim's own code looked up in the diagnosis dimension; a claim without one has no key."""
    safe = _safe(spark, folder)
    claims = materialize(safe["claims"], "safe-claims")
    coded = claims.select("claim_id", F.col("icd10_code").alias("final_diagnosis"))
    return star.add_diagnosis_sk(coded, star.dim_diagnosis(claims, safe["encounters"]))


@query
def lookup_date(spark, folder):
    claims = materialize(_safe(spark, folder)["claims"], "safe-claims")
    return star.add_date_sk(claims.select("claim_id", "service_date"), star.dim_date(claims))


@query
def fact_claims(spark, folder):
    return _star(spark, folder)["fact_claims"]


@query
def fact_claims_null_safe(spark, folder):
    """A fact without a diagnosis refers to the NULL row of the dimension."""
    return _star(spark, folder, null_safe=True)["fact_claims"]


@query
def fact_claims_by_claim(spark, folder):
    """One row per claim, with the codes of the nearest encounter."""
    safe = _safe(spark, folder)
    claims, encounters = (materialize(safe[name], f"safe-{name}") for name in ("claims", "encounters"))
    dims = star.build_dims(claims, safe["patients"], star.fold_visits(encounters))
    return star.build_fact_by_claim(claims, encounters, dims)


# --- as-of, daily loads, subtotals ---


def _stored_safe(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Safe tables with encounters over the years of the claims."""
    return {name: materialize(table, f"safe-{name}") for name, table in _safe(spark, folder, views.encounters_over_years).items()}


@query
def asof_encounter(spark, folder):
    """The last encounter on or before the day of the claim, at most 30 days back."""
    safe = _stored_safe(spark, folder)
    claims = safe["claims"].select(*CLAIM_KEY, "member_key")
    values = ["encounter_id", "encounter_date", "diagnosis_code"]
    return asof.as_of(claims, safe["encounters"], "member_key", ("service_date", "encounter_date"), values, tolerance=30)


@query
def asof_next_encounter(spark, folder):
    """The first encounter on or after the day of the claim, however late, with ranges that cut members."""
    safe = _stored_safe(spark, folder)
    claims = safe["claims"].select(*CLAIM_KEY, "member_key")
    values = ["encounter_id", "encounter_date"]
    on = ("service_date", "encounter_date")
    return asof.as_of(claims, safe["encounters"], "member_key", on, values, direction="forward", ranges=199)


@query
def daily_dim_member(spark, folder):
    """Two days of patients, the second one sent twice: members of the first day keep their numbers."""
    path = new_path(spark, "registry")
    patients = masking.deidentify(views.patients_with_gaps(spark, folder), SALT)
    members = star.dim_rows(star.known_members(patients), ["member_key", "gender"])
    for day in (members.filter(F.col("member_key") < "8"), members, members):
        incremental.extend_registry(spark, path, day, ["member_key"], "member_sk")
    return read_table(spark, path)


@query
def daily_fact(spark, folder):
    """Claims up to 1995 on the first day, all of them on the second, which is then run again; one row per claim."""
    safe = _stored_safe(spark, folder)
    zones = Zones.under(new_path(spark, "daily"))
    first = safe["claims"].filter(F.col("service_date") < "1995-01-01")
    for claims in (first, safe["claims"], safe["claims"]):
        stages.run_daily(spark, claims, safe["patients"], safe["encounters"], zones, grain="claim")
    return read_table(spark, zones.model("fact_claims"))


@query
def load_only_new(spark, folder):
    """Claims loaded in three overlapping parts end up once each."""
    path = new_path(spark, "load")
    claims = views.claims(spark, folder)
    number = F.col("claim_id").cast("long")
    for part in (claims.filter(number % 3 != 0), claims.filter(number % 3 != 1), claims):
        incremental.load_once(spark, path, part, ["claim_id", "service_date"])
    return read_table(spark, path)


@query
def paid_by_diagnosis_and_month(spark, folder):
    """Paid against allowed with all subtotals, from the fact that repeats claims; each claim once in every group."""
    tables = _star(spark, folder)
    fact = star.add_names(tables["fact_claims"], tables)
    dims = ["final_diagnosis", "year", "month"]
    sets = rollup.rollup_sets(dims)
    return rollup.totals_once(fact, dims, sets, ["claim_id", "date_sk"], ["paid_amount", "allowed_amount"])


@query
def paid_cube(spark, folder):
    """Every combination of diagnosis, provider and procedure, each claim once in every group."""
    tables = _star(spark, folder)
    fact = star.add_names(tables["fact_claims"], tables)
    dims = ["final_diagnosis", "provider_id", "final_procedure"]
    return rollup.totals_once(fact, dims, rollup.cube_sets(dims), ["claim_id", "date_sk"], ["paid_amount"])


@query
def top_providers(spark, folder):
    """The three providers of a month with the greatest paid amount, each claim counted once."""
    tables = _star(spark, folder)
    fact = star.add_names(tables["fact_claims"], tables)
    dims = ["year", "month", "provider_id"]
    paid = rollup.totals_once(fact, dims, [dims], ["claim_id", "date_sk"], ["paid_amount"]).drop("level")
    return top.top_k(paid, ["year", "month"], "paid_amount", ["provider_id"], 3)


# --- bags, episodes, intervals ---


def _coded(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Code pairs of all claims, copies kept, and those of the negative ones sent again three times."""
    claims = views.claims(spark, folder)
    codes = claims.select("icd10_code", "cpt_code", "provider_id")
    negative = claims.filter(c.is_negative(F.col("paid_amount"))).select("provider_id", "icd10_code", "cpt_code")
    return codes, rows.union_rows(negative, negative, negative)


@query
def except_all_rows(spark, folder):
    return rows.except_all_rows(*_coded(spark, folder))


@query
def intersect_all_rows(spark, folder):
    return rows.intersect_all_rows(*_coded(spark, folder))


@query
def episodes_of_care(spark, folder):
    return episodes.episodes(_safe(spark, folder, views.encounters_over_years)["encounters"], "member_key", "encounter_date", gap_days=7)


@query
def episodes_of_care_in_ranges(spark, folder):
    """Ranges so small that most members are cut."""
    return episodes.episodes(_safe(spark, folder, views.encounters_over_years)["encounters"], "member_key", "encounter_date", gap_days=3, ranges=331)


@query
def episodes_streamed(spark, folder):
    """Encounters in three drops by time; a last row far ahead closes what is open."""
    root = new_path(spark, "episode-stream")
    visits = materialize(_safe(spark, folder, views.encounters_over_years)["encounters"].select("member_key", "encounter_date"), "visits")
    ends = visits.agg(F.min("encounter_date").alias("first"), F.max("encounter_date").alias("last")).first()
    third = (ends["last"] - ends["first"]).days // 3
    part = F.least(F.floor(F.datediff("encounter_date", F.lit(ends["first"])) / (third + 1)), F.lit(2))
    flush = visits.limit(1).select(F.lit(None).cast("string").alias("member_key"), F.lit(ends["last"]).alias("encounter_date"))
    flush = flush.withColumn("encounter_date", F.date_add("encounter_date", 1000))
    for drop in (*[visits.filter(part == i) for i in range(3)], flush):
        drop.write.mode("append").parquet(f"{root}/feed")
        episode_stream.run_episode_stream(spark, f"{root}/feed", f"{root}/out", f"{root}/checkpoint", "member_key", "encounter_date", 7, 1)
    return spark.read.parquet(f"{root}/out").drop("batch")


@query
def claims_in_episodes(spark, folder):
    """Claims whose day lies in an episode of their member."""
    safe = _stored_safe(spark, folder)
    periods = episodes.episodes(safe["encounters"], "member_key", "encounter_date", gap_days=30).drop("days")
    return intervals.within(safe["claims"].select("claim_id", "service_date", "member_key"), periods, "member_key", "service_date", ("first_day", "last_day"))


@query
def claims_in_long_periods(spark, folder):
    """From the first to the last encounter of a member, which may be years, and claims outside kept."""
    safe = _stored_safe(spark, folder)
    known = safe["encounters"].filter(F.col("member_key").isNotNull())
    periods = known.groupBy("member_key").agg(
        F.date_add(F.min("encounter_date"), 300).alias("first_day"), F.date_sub(F.max("encounter_date"), 300).alias("last_day")
    )
    claims = safe["claims"].select("claim_id", "service_date", "member_key")
    return intervals.within(claims, periods, "member_key", "service_date", ("first_day", "last_day"), width=7, how="left")


# --- quality as a stream ---


def _streamed(spark: SparkSession, drops: list[DataFrame], delay_days: int) -> tuple[quality_stream.StreamFeed, quality_stream.StreamTarget]:
    """Run the quality stream after each drop of files."""
    root = new_path(spark, "quality-stream")
    rules = r.DEFAULT_RULES
    feed = quality_stream.StreamFeed(CLAIMS, rules.claims, CLAIM_KEY, "service_date", CLAIMS_REASON, rules.code_columns, delay_days)
    target = quality_stream.StreamTarget(f"{root}/good", f"{root}/quarantine", f"{root}/checkpoint")
    for drop in drops:
        drop.write.mode("append").parquet(f"{root}/feed")
        quality_stream.run_stream(spark, f"{root}/feed", feed, target)
    return feed, target


@query
def stream_good(spark, folder):
    """Claims in three drops, the second with claims of the first at another amount: what the batch job makes of all."""
    claims = views.claims(spark, folder)
    number = F.col("claim_id").cast("long") % 3
    again = claims.filter(number == 0).withColumn("paid_amount", F.col("paid_amount") + 1)
    drops = [claims.filter(number == 0), rows.union_rows(claims.filter(number == 1), again), claims.filter(number == 2)]
    feed, target = _streamed(spark, drops, delay_days=100_000)
    return quality_stream.good_rows(spark, feed, target)


@query
def stream_quarantine(spark, folder):
    """Two drops; claims of the second that lie more than a year before the first one's end are late."""
    claims = views.claims(spark, folder)
    number = F.col("claim_id").cast("long") % 2
    _, target = _streamed(spark, [claims.filter(number == 0), claims.filter(number == 1)], delay_days=365)
    return quality_stream.rejected_rows(spark, target).withColumn("reasons", F.array_join("reasons", ","))


# --- sketches, layout, types ---


@query
def profile_claims(spark, folder):
    """The type each column of the feed allows; some dates of it cannot be read, so that column stays text."""
    return profile.profile(views.feed_claims(spark, folder).drop("paid_amount", "allowed_amount"))


@query
def profile_patients(spark, folder):
    return profile.profile(views.patients_with_gaps(spark, folder).select([F.col(n).cast("string") for n in ("patient_id", "zip", "dob", "gender")]))


def _days(spark: SparkSession, folder: str) -> DataFrame:
    claims = _stored_safe(spark, folder)["claims"].filter(F.col("service_date").isNotNull())
    return claims.withColumn("year", F.year("service_date"))


@query
def paid_quantiles(spark, folder):
    """Quantiles of the paid amount per year, merged from sketches per day, each within 1% of the true one."""
    daily = materialize(sketches.quantile_sketches(_days(spark, folder), ["year", "service_date"], "paid_amount"), "daily-quantiles")
    shares = [0.1, 0.5, 0.9, 0.99]
    found = sketches.merged_quantiles(daily, ["year"], shares)
    exact = _days(spark, folder).groupBy("year").agg(F.sort_array(F.collect_list("paid_amount")).alias("all"))
    both = found.join(exact, "year")
    true = F.element_at("all", F.greatest(F.ceil(F.col("share") * F.size("all")), F.lit(1)).cast("int"))
    return both.select("year", "share", true.alias("paid"), (F.abs(F.col("value") - true) <= F.abs(true) * 0.0100001).alias("within"))


@query
def members_per_year(spark, folder):
    """Distinct members per year, merged from sketches per day, beside the exact number and whether four errors hold them apart."""
    claims = _days(spark, folder)
    daily = materialize(sketches.distinct_sketches(claims, ["year", "service_date"], "member_key"), "daily-members")
    found = sketches.merged_distinct(daily, ["year"])
    exact = claims.groupBy("year").agg(F.count_distinct("member_key").alias("members"))
    apart = F.abs(F.col("estimate") - F.col("members")) <= 4 * sketches.DISTINCT_ERROR * F.col("members") + 1
    return found.join(exact, "year").select("year", "members", apart.alias("within"))


@query
def fact_by_month(spark, folder):
    """The fact by month and member bucket, of which one month is then computed again with other amounts."""
    tables = _star(spark, folder)
    fact = star.lookup(tables["fact_claims"], tables["dim_date"].select("date_sk", "date"), "date_sk", spread_by=("claim_id", "date_sk"))
    fact = materialize(fact.withColumn("month", partitioned.month_of(F.col("date"))).drop("date"), "fact")
    name, path = f"fact_{uuid.uuid4().hex}", new_path(spark, "fact-by-month")
    partitioned.write_by_month(fact, name, path, "member_sk", 8)
    again = fact.filter("month = '1995-03'").withColumn("paid_amount", F.col("paid_amount") * 2)
    partitioned.replace_months(spark, name, again, "member_sk", 8)
    return spark.table(name)


# --- the routes for large tables, forced on small ones ---


@query
def integrate_claims_spread(spark, folder):
    safe = _safe(spark, folder)
    claims, encounters = (materialize(safe[name], f"safe-{name}") for name in ("claims", "encounters"))
    return integrate.integrate(claims, encounters, limits=SPREAD)


@query
def fact_claims_spread(spark, folder):
    return _star(spark, folder, SPREAD)["fact_claims"]


@query
def mask_claims_spread(spark, folder):
    mapping = masking.key_mapping(views.patients(spark, folder), SALT, limits=SPREAD)
    claims = views.claims_with_strangers(spark, folder)
    return masking.replace_id(claims, "member_id", mapping, spread_by=("claim_id",), limits=SPREAD)


@query
def join_left_anti_spread(spark, folder):
    seen = views.encounters(spark, folder).select(F.col("patient_id").alias("member_id"))
    return joins.anti_join(views.claims(spark, folder), seen, "member_id", limits=SPREAD, spread_by=("claim_id",))
