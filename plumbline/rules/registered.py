"""Rules that follow from a registered dataset alone."""

from __future__ import annotations

from collections.abc import Sequence

from plumbline.functions.predicates import InSet, NotBlank, ValidDate
from plumbline.model import DatasetSpec, Rule
from plumbline.operators.keys import UniqueKey


def spec_rules(spec: DatasetSpec, columns: Sequence[str]) -> tuple[Rule, ...]:
    """A key that is present and unique, dates that are dates, values that are listed.

    Lists of columns that the dataset does not have make no rule: other rules may refer to them. Required columns are
    checked by the schema rule.
    """
    key = spec.primary_key
    rules = [
        Rule("KEY_001", "Completeness", "Critical", NotBlank(key), f"Each row has a {key}.",
             "Reject rows without key at the source.", (key,), f"Missing {key}"),
        Rule("KEY_002", "Uniqueness", "Critical", UniqueKey((key,), strip=True, ignore_blank=True), f"No two rows share a {key}.",
             "Compare the copies.", (key,), f"Duplicate {key}"),
    ]
    for c in spec.date_columns:
        if c in columns:
            rules.append(Rule(f"DATE_{c}", "Validity", "High", ValidDate(c), f"{c} is a date.",
                              "Repair the date.", (key, c), f"Invalid {c}"))
    for c, allowed in spec.allowed_values.items():
        if c in columns:
            rules.append(Rule(f"SET_{c}", "Validity", "High", InSet(c, tuple(allowed), strip=True), f"{c} is a listed value.",
                              "Map the value to the list.", (key, c), f"Invalid {c}"))
    return tuple(rules)
