"""Enrichment of claims from the encounters of the same member."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clinflow.functions.columns import first_code
from clinflow.operators.asof import as_of
from clinflow.operators.joins import DEFAULT_LIMITS, JoinLimits, hot_keys, measured_bytes, part_hot, spread_join
from clinflow.operators.rows import fold_copies, unfold_copies
from clinflow.schemas import CLAIM_KEY, ENCOUNTER_KEY
from clinflow.scratch import materialize

# How many encounters a row stands for; expanded to that many rows at the very end.
COPIES = "copies"
# Tells apart the rows that stand for equal encounters.
PIECE = "__piece"
# A row never stands for more, so expanding one row stays a small array.
MAX_COPIES = 65_536

ENCOUNTER_DETAIL = ("diagnosis_code", "procedure_code", "encounter_date")
ENCOUNTER_CODES = ("diagnosis_code", "procedure_code")


def fold_encounters(encounters: DataFrame, columns: Sequence[str], max_copies: int = MAX_COPIES) -> DataFrame:
    """Equal encounters of a member become one row with their number in ``copies``, very large numbers several."""
    known = encounters.filter(F.col("member_key").isNotNull())
    return fold_copies(known, ["member_key", *columns], COPIES, PIECE, max_copies)


def expand_copies(df: DataFrame) -> DataFrame:
    """Each row as many times as its ``copies`` says; a narrow step."""
    return unfold_copies(df, COPIES).drop(COPIES, PIECE)


def heavy_members(visits: DataFrame, limits: JoinLimits = DEFAULT_LIMITS) -> dict[tuple, int]:
    """Members whose folded rows stand for very many encounters, few though the folded rows may be."""
    return hot_keys(visits, ["member_key"], limits, weight=COPIES)


def link_members(
    claims: DataFrame,
    member_rows: DataFrame,
    size_bound: int,
    heavy: dict[tuple, int],
    keys_from: DataFrame | None = None,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Claims left-joined to folded rows on ``member_key``; a claim without any stands for itself once."""
    linked = spread_join(
        claims,
        member_rows,
        "member_key",
        spread_by=CLAIM_KEY,
        right_bytes=size_bound,
        right_hot=heavy,
        keys_from=keys_from,
        limits=limits,
    )
    return linked.withColumn(COPIES, F.coalesce(COPIES, F.lit(1)))


def add_final_codes(df: DataFrame, missing_codes: Sequence[str] = ()) -> DataFrame:
    """The claim's code, or the encounter's where the claim has none.

    ``missing_codes`` lists codes to read as "none", such as "UNKNOWN"; by default every code counts.
    """
    return df.withColumns(
        {
            "final_diagnosis": first_code(F.col("icd10_code"), F.col("diagnosis_code"), missing=missing_codes),
            "final_procedure": first_code(F.col("cpt_code"), F.col("procedure_code"), missing=missing_codes),
        }
    )


def integrate(
    claims: DataFrame,
    encounters: DataFrame,
    missing_codes: Sequence[str] = (),
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """One row per claim and encounter of its member, claims without encounters once, final codes added.

    The encounter side is every encounter of the member, whatever its date, so measures of a claim
    repeat: sum them per claim, not over these rows. Both sides are as deduplicated: the keys they
    were deduplicated on tell apart the rows of a hot member.
    """
    visits = encounters.filter(F.col("member_key").isNotNull())
    visits = visits.select("member_key", *ENCOUNTER_DETAIL, *ENCOUNTER_KEY)
    linked = spread_join(claims, visits, "member_key", spread_by=CLAIM_KEY, limits=limits)
    return add_final_codes(linked.drop(*ENCOUNTER_KEY), missing_codes)


def _sharing(claims: DataFrame, encounters: DataFrame, limits: JoinLimits) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(claims that can meet an encounter, all other claims, encounters that can meet a claim), as far as the members tell.

    The members of either side are broadcast to the scan of the other, unless they are too many; the claims must be stored.
    """

    def members(df: DataFrame) -> DataFrame | None:
        known = df.select("member_key").filter(F.col("member_key").isNotNull()).distinct()
        kept = materialize(known, "members")
        return kept if measured_bytes(kept, limits.broadcast_bytes) <= limits.broadcast_bytes else None

    dated = claims.filter(F.col("service_date").isNotNull())
    asked = members(dated)
    if asked is not None:
        encounters = encounters.join(F.broadcast(asked), "member_key", "left_semi")
    offered = members(encounters.filter(F.col("encounter_date").isNotNull()))
    undated = claims.filter(F.col("service_date").isNull())
    if offered is None:
        return dated, undated, encounters
    asking, alone = part_hot(dated, ["member_key"], offered)
    return asking, alone.union(undated), encounters


def with_nearest_encounter(
    claims: DataFrame, encounters: DataFrame, ranges: int | None = None, wanted: Column | None = None, limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Claims, each once, with the codes of the encounter of the member nearest in days, ties by id; NULLs if there is none.

    Claims without a date meet no encounter, and encounters without one are met by none, nor do claims that are not ``wanted``, if
    that is given. Linear in both, see ``asof``; only rows of members that both sides have are put in order.
    """
    needed = F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False))
    asking, alone, encounters = _sharing(claims.filter(needed), encounters, limits)
    found = as_of(
        asking,
        encounters,
        by="member_key",
        on=("service_date", "encounter_date"),
        values=[*ENCOUNTER_KEY, *ENCOUNTER_CODES],
        direction="nearest",
        ranges=ranges,
    )
    types = {name: encounters.schema[name].dataType for name in ENCOUNTER_CODES}
    rest = alone.union(claims.filter(~needed)).withColumns({name: F.lit(None).cast(types[name]) for name in ENCOUNTER_CODES})
    return found.drop(*ENCOUNTER_KEY).unionByName(rest)
