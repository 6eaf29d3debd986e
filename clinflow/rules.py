"""Quality rules as data: which columns must be filled, which must not be negative."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession, functions as F

from clinflow.functions.columns import is_filled, is_negative


@dataclass(frozen=True)
class Rule:
    """One check on one column. ``passes()`` is never NULL, so its negation is the exact complement."""

    kind: str
    column: str

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}"

    def passes(self) -> Column:
        if self.kind == "not_null":
            return is_filled(F.col(self.column))
        if self.kind == "non_negative":
            return ~is_negative(F.col(self.column))
        raise ValueError(f"unknown rule kind: {self.kind}")


def not_null(columns: Sequence[str]) -> list[Rule]:
    return [Rule("not_null", name) for name in columns]


def non_negative(columns: Sequence[str]) -> list[Rule]:
    return [Rule("non_negative", name) for name in columns]


@dataclass(frozen=True)
class RuleSet:
    """Rules per feed, and the code columns to standardize."""

    claims: list[Rule] = field(default_factory=list)
    encounters: list[Rule] = field(default_factory=list)
    code_columns: tuple[str, ...] = ()

    @classmethod
    def from_mapping(cls, settings: Mapping) -> RuleSet:
        """Read ``{"dq_rules": {"claims"|"ehr": {...}}, "standardization": {"uppercase_cols": [...]}}``.

        Both feeds must be there, and no unknown kind of rule: a misspelt name must not switch off a check.
        """

        def rules_for(feed: str) -> list[Rule]:
            lists = settings.get("dq_rules", {}).get(feed)
            if lists is None:
                raise ValueError(f"no rules for feed: {feed}")
            unknown = sorted(set(lists) - {"not_null", "non_negative"})
            if unknown:
                raise ValueError(f"unknown kinds of rule for feed {feed}: {', '.join(unknown)}")
            return not_null(lists.get("not_null", ())) + non_negative(lists.get("non_negative", ()))

        codes = settings.get("standardization", {}).get("uppercase_cols", ())
        return cls(rules_for("claims"), rules_for("ehr"), tuple(codes))

    def as_mapping(self) -> dict:
        """What ``from_mapping`` reads."""

        def lists(rules: list[Rule]) -> dict[str, list[str]]:
            kinds = dict.fromkeys(rule.kind for rule in rules)
            return {kind: [rule.column for rule in rules if rule.kind == kind] for kind in kinds}

        return {
            "dq_rules": {"claims": lists(self.claims), "ehr": lists(self.encounters)},
            "standardization": {"uppercase_cols": list(self.code_columns)},
        }


def load_rules(spark: SparkSession, path: str) -> RuleSet:
    """Read a JSON rule file from any file system Spark can reach."""
    document = spark.read.text(path, wholetext=True).head()
    if document is None:
        raise ValueError(f"rule file is empty: {path}")
    return RuleSet.from_mapping(json.loads(document.value))


# The rule lists in force unless a rule file says otherwise.
DEFAULT_RULES = RuleSet.from_mapping(
    {
        "dq_rules": {
            "claims": {
                "not_null": ["claim_id", "member_id", "provider_id", "service_date"],
                "non_negative": ["paid_amount", "allowed_amount"],
            },
            "ehr": {"not_null": ["patient_id", "encounter_id", "encounter_date"]},
        },
        "standardization": {
            "uppercase_cols": ["icd10_code", "cpt_code", "diagnosis_code", "procedure_code"],
        },
    }
)
