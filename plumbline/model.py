"""Plain data types: rules, rule groups and dataset specifications."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Union

from plumbline.functions.predicates import RowCheck
from plumbline.operators.keys import KeyCheck


@dataclass(frozen=True)
class Rule:
    """One check with the facts that are reported next to its result."""

    rule_id: str
    dimension: str
    severity: str
    check: Union[RowCheck, KeyCheck]
    description: str
    recommendation: str
    evidence: tuple[str, ...] = ()
    issue_type: str | None = None

    @property
    def issue(self) -> str:
        return self.issue_type or self.description


@dataclass(frozen=True)
class DatasetSpec:
    """A registered dataset: where it lives and what it must contain."""

    name: str
    path: str
    primary_key: str
    required_columns: tuple[str, ...] = ()
    date_columns: tuple[str, ...] = ()
    numeric_columns: tuple[str, ...] = ()
    allowed_values: dict[str, tuple[str, ...]] = field(default_factory=dict)
    description: str = ""

    def missing_columns(self, columns: list[str]) -> list[str]:
        return [c for c in self.required_columns if c not in columns]
