"""Dimensions and the fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from clinflow.functions.columns import as_amount, calendar_parts, known_code
from clinflow.operators.integrate import (
    COPIES,
    ENCOUNTER_CODES,
    PIECE,
    add_final_codes,
    expand_copies,
    fold_encounters,
    heavy_members,
    link_members,
    with_nearest_encounter,
)
from clinflow.operators.joins import DEFAULT_LIMITS, JoinLimits, lookup, measured_sizes, part_hot
from clinflow.operators.numbering import ROWS_PER_TASK, number_rows
from clinflow.schemas import CLAIM_KEY, FACT_CLAIMS
from clinflow.scratch import materialize, side_by_side


def build_dim(
    df: DataFrame,
    columns: Sequence[str],
    key_name: str,
    rows_per_task: int = ROWS_PER_TASK,
    natural: int = 1,
) -> DataFrame:
    """One row per value of the first ``natural`` columns, with a dense key in their order; NULL is a value of its own.

    The further columns are those of the natural key's least row, filled values before NULLs, so that no
    row is put together from several.
    """
    return number_rows(dim_rows(df, columns, natural), list(columns[:natural]), key_name, rows_per_task)


def dim_rows(df: DataFrame, columns: Sequence[str], natural: int = 1) -> DataFrame:
    """The rows of a dimension without their surrogate key."""
    natural_key, attributes = list(columns[:natural]), columns[natural:]
    if not attributes:
        return df.select(*natural_key).distinct()
    ranked = [part for name in attributes for part in (F.col(name).isNull().alias(f"no_{name}"), F.col(name))]
    keys = df.groupBy(*natural_key).agg(F.min(F.struct(*ranked)).alias("__least"))
    return keys.select(*natural_key, *[F.col(f"__least.{name}") for name in attributes])


def dates_of(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("date")).filter(F.col("date").isNotNull())


def with_calendar(dates: DataFrame) -> DataFrame:
    return dates.withColumns(calendar_parts(F.col("date"))).select("date", "year", "month", "day", "date_sk")


def build_date_dim(df: DataFrame, column: str) -> DataFrame:
    """The dates that occur, with their calendar parts; no gaps are filled."""
    return with_calendar(build_dim(dates_of(df, column), ["date"], "date_sk"))


def known_members(patients: DataFrame) -> DataFrame:
    return patients.filter(F.col("member_key").isNotNull())


def dim_member(patients: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Members that have a key; the warehouse refuses any other."""
    return build_dim(known_members(patients), ["member_key", "gender"], "member_sk", rows_per_task)


def dim_provider(claims: DataFrame) -> DataFrame:
    """Providers of the claims; enrichment keeps every claim, so the claims alone hold them all."""
    return build_dim(claims, ["provider_id"], "provider_sk")


def final_diagnoses(claims: DataFrame, visits: DataFrame, missing_codes: Sequence[str] = ()) -> DataFrame:
    """Every final diagnosis the integrated claims hold, without integrating them.

    ``visits`` are encounters, folded or not. Only members with an uncoded claim look to them. Codes,
    those members and what visits offer them are made distinct before the join, so no key has many
    rows left in it.
    """
    own = known_code(F.col("icd10_code"), missing_codes)
    offer = known_code(F.col("diagnosis_code"), missing_codes)
    wanted = claims.select(
        own.alias("own_code"), F.when(own.isNull(), F.col("member_key")).alias("member_key")
    ).distinct()
    offered = visits.select("member_key", offer.alias("offered_code")).distinct()
    found = F.coalesce("own_code", "offered_code").alias("final_diagnosis")
    return wanted.join(offered, "member_key", "left").select(found)


def dim_diagnosis(claims: DataFrame, visits: DataFrame, missing_codes: Sequence[str] = ()) -> DataFrame:
    return build_dim(final_diagnoses(claims, visits, missing_codes), ["final_diagnosis"], "diagnosis_sk")


def dim_date(claims: DataFrame) -> DataFrame:
    return build_date_dim(claims, "service_date")


def fold_visits(encounters: DataFrame) -> DataFrame:
    """What dimensions and fact need of the encounters, folded and written out for both."""
    return materialize(fold_encounters(encounters, ENCOUNTER_CODES), "visits")


def build_dims(
    claims: DataFrame, patients: DataFrame, visits: DataFrame, missing_codes: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """The four dimensions; none needs another, so their jobs run at the same time."""
    return side_by_side(
        {
            "dim_member": lambda: dim_member(patients),
            "dim_provider": lambda: dim_provider(claims),
            "dim_diagnosis": lambda: dim_diagnosis(claims, visits, missing_codes),
            "dim_date": lambda: dim_date(claims),
        }
    )


def add_member_sk(df: DataFrame, dim: DataFrame, **options) -> DataFrame:
    return lookup(df, dim.select("member_key", "member_sk"), "member_key", **options)


def add_provider_sk(df: DataFrame, dim: DataFrame, **options) -> DataFrame:
    return lookup(df, dim.select("provider_id", "provider_sk"), "provider_id", **options)


def add_diagnosis_sk(df: DataFrame, dim: DataFrame, **options) -> DataFrame:
    """A missing diagnosis has no key, unless ``null_safe=True`` gives it that of the NULL row."""
    return lookup(df, dim.select("final_diagnosis", "diagnosis_sk"), "final_diagnosis", **options)


def add_date_sk(df: DataFrame, dim: DataFrame, **options) -> DataFrame:
    reference = dim.select(F.col("date").alias("service_date"), "date_sk")
    return lookup(df, reference, "service_date", **options)


def member_side(members: DataFrame, visits: DataFrame, heavy: Mapping[tuple, int]) -> DataFrame:
    """Everything a member adds to a claim: the surrogate key and the visits, either of which may lack.

    Visits of heavy members stay where they are and meet a broadcast of those few members.
    """
    if not heavy:
        return members.join(visits, "member_key", "full")
    keys = members.sparkSession.createDataFrame(list(heavy), "member_key string")
    few, others = part_hot(members, ["member_key"], keys)
    many, rest = part_hot(visits, ["member_key"], keys)
    known = many.join(F.broadcast(few), "member_key", "left")
    return others.join(rest, "member_key", "full").unionByName(known)


def build_fact(
    claims: DataFrame,
    visits: DataFrame,
    dims: Mapping[str, DataFrame],
    missing_codes: Sequence[str] = (),
    null_safe: bool = False,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """One row per claim and encounter of its member, claims without encounters once.

    ``visits`` come from ``fold_visits``. Lookups run before rows multiply: provider and date on the
    claims, member keys together with the visits so that claims shuffle on the member at most once.
    Rows reach their final number only in the last, narrow step.
    """
    members = dims["dim_member"].filter(F.col("member_key").isNotNull()).select("member_key", "member_sk")
    sides = {"members": members, "visits": visits, **{name: dims[name] for name in dims if name != "dim_member"}}
    size = measured_sizes(sides, limits.broadcast_bytes)
    heavy = heavy_members(visits, limits)
    member_rows = member_side(members, visits, heavy)

    keyed = claims.select(
        "claim_id",
        "service_date",
        "provider_id",
        "member_key",
        as_amount(F.col("paid_amount")).alias("paid_amount"),
        as_amount(F.col("allowed_amount")).alias("allowed_amount"),
        "icd10_code",
        "cpt_code",
    )

    def by_claim(side: str, *more: str) -> dict:
        return {"spread_by": (*CLAIM_KEY, *more), "limits": limits, "right_bytes": size[side]}

    keyed = add_date_sk(keyed, dims["dim_date"], keys_from=claims, **by_claim("dim_date"))
    keyed = add_provider_sk(keyed, dims["dim_provider"], keys_from=claims, **by_claim("dim_provider"))
    # Every visit also gets its member's key, 8 bytes, where its size counts 16 a row at least.
    bound = size["members"] + size["visits"] + size["visits"] // 2
    linked = link_members(keyed, member_rows, bound, heavy, keys_from=claims, limits=limits)
    linked = add_final_codes(linked, missing_codes)
    # Hot codes show on the claims and visits they come from, without running the join above.
    codes = claims.select(F.col("icd10_code").alias("final_diagnosis")).union(visits.select("diagnosis_code"))
    linked = add_diagnosis_sk(
        linked, dims["dim_diagnosis"], null_safe=null_safe, keys_from=codes, **by_claim("dim_diagnosis", PIECE)
    )
    return expand_copies(linked.select(*FACT_CLAIMS.columns.names, COPIES))


def build_fact_by_claim(
    claims: DataFrame,
    encounters: DataFrame,
    dims: Mapping[str, DataFrame],
    missing_codes: Sequence[str] = (),
    null_safe: bool = False,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """One row per claim: codes it lacks come from the nearest encounter of its member, if there is one.

    Claims that lack none do not look for one.
    """
    lacks = [known_code(F.col(name), missing_codes).isNull() for name in ("icd10_code", "cpt_code")]
    linked = with_nearest_encounter(claims, encounters, wanted=lacks[0] | lacks[1], limits=limits)
    linked = linked.withColumns({name: as_amount(F.col(name)) for name in ("paid_amount", "allowed_amount")})
    keyed = add_final_codes(linked, missing_codes)
    members = dims["dim_member"].filter(F.col("member_key").isNotNull())
    keyed = add_member_sk(keyed, members, spread_by=CLAIM_KEY, keys_from=claims, limits=limits)
    keyed = add_provider_sk(keyed, dims["dim_provider"], spread_by=CLAIM_KEY, keys_from=claims, limits=limits)
    keyed = add_date_sk(keyed, dims["dim_date"], spread_by=CLAIM_KEY, keys_from=claims, limits=limits)
    keyed = add_diagnosis_sk(keyed, dims["dim_diagnosis"], null_safe=null_safe, spread_by=CLAIM_KEY, limits=limits)
    return keyed.select(*FACT_CLAIMS.columns.names)


def add_names(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The fact with provider, diagnosis, date and its calendar parts beside their surrogate keys."""
    named = fact
    for name, key in (("dim_provider", "provider_sk"), ("dim_diagnosis", "diagnosis_sk"), ("dim_date", "date_sk")):
        named = lookup(named, dims[name], key, spread_by=("claim_id", "date_sk"))
    return named
