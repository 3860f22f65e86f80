"""Row-local rule kinds.

Every kind is a small declarative value; ``failing`` turns it into a SQL condition that is true for
rows breaking the rule. The condition may be null, and null counts as passing, so kinds in which a
null must fail say so themselves. ``as_of`` is a SQL date expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from plumbline.functions.dates import age_in_days, parse_date
from plumbline.functions.numbers import parse_number
from plumbline.functions.text import (
    is_blank, literal, literals, name, strip, stripped_equals, stripped_in,
)


class RowCheck:
    """A rule that is decided by looking at one row."""

    def failing(self, as_of: str) -> str:
        raise NotImplementedError

    def failed(self, as_of: str) -> str:
        """The condition with null decided as passing."""
        return f"coalesce({self.failing(as_of)}, false)"


def _flag(value: bool) -> str:
    return "true" if value else "false"


@dataclass(frozen=True)
class NotNull(RowCheck):
    column: str

    def failing(self, as_of):
        return f"{name(self.column)} IS NULL"


@dataclass(frozen=True)
class NotBlank(RowCheck):
    column: str

    def failing(self, as_of):
        return is_blank(name(self.column))


@dataclass(frozen=True)
class NotSentinel(RowCheck):
    """Blank values and known placeholder values fail."""

    column: str
    sentinels: tuple[str, ...]

    def failing(self, as_of):
        c = name(self.column)
        return " OR ".join([is_blank(c), *[stripped_equals(c, s) for s in self.sentinels]])


@dataclass(frozen=True)
class InSet(RowCheck):
    """The value must be one of a short list. Null fails unless ``null_fails`` is off."""

    column: str
    allowed: tuple[str, ...]
    strip: bool = False
    null_fails: bool = True

    def failing(self, as_of):
        c = name(self.column)
        if self.strip:
            return f"NOT {stripped_in(c, self.allowed)}"
        return f"coalesce({c} NOT IN ({literals(self.allowed)}), {_flag(self.null_fails)})"


@dataclass(frozen=True)
class Between(RowCheck):
    """Closed range; missing and unparseable values fail unless ``null_fails`` is off."""

    column: str
    low: float
    high: float
    null_fails: bool = True

    def failing(self, as_of):
        value = parse_number(name(self.column))
        if self.null_fails:
            return f"NOT coalesce({value} BETWEEN {self.low} AND {self.high}, false)"
        return f"{value} < {self.low} OR ({value} > {self.high} AND NOT isnan({value}))"


@dataclass(frozen=True)
class PositiveNumber(RowCheck):
    column: str

    def failing(self, as_of):
        value = parse_number(name(self.column))
        return f"NOT coalesce({value} > 0 AND NOT isnan({value}), false)"


@dataclass(frozen=True)
class NotBelow(RowCheck):
    """Numbers from ``low`` up to, but not reaching, ``threshold`` fail."""

    column: str
    threshold: float
    low: float | None = 0.0
    null_fails: bool = False

    def failing(self, as_of):
        value = parse_number(name(self.column))
        weak = f"{value} < {self.threshold}"
        if self.low is not None:
            weak = f"({weak} AND {value} >= {self.low})"
        if self.null_fails:
            return f"coalesce({weak}, true) OR isnan({value})"
        return weak


@dataclass(frozen=True)
class ValidDate(RowCheck):
    column: str

    def failing(self, as_of):
        return f"{parse_date(name(self.column))} IS NULL"


@dataclass(frozen=True)
class DateOrder(RowCheck):
    """``later`` must not be before ``earlier``; only checked when both are dates."""

    earlier: str
    later: str

    def failing(self, as_of):
        return f"{parse_date(name(self.later))} < {parse_date(name(self.earlier))}"


@dataclass(frozen=True)
class NotFuture(RowCheck):
    column: str

    def failing(self, as_of):
        return f"{parse_date(name(self.column))} > {as_of}"


@dataclass(frozen=True)
class NotOverdue(RowCheck):
    column: str

    def failing(self, as_of):
        return f"{parse_date(name(self.column))} < {as_of}"


@dataclass(frozen=True)
class FreshWithin(RowCheck):
    """Dates more than ``days`` old fail; ``inclusive`` also fails a date exactly that old.

    ``only`` limits the rule to rows in which a column holds one of the given values.
    """

    column: str
    days: int = 365
    inclusive: bool = False
    only: tuple[str, tuple[str, ...]] | None = None

    def failing(self, as_of):
        stale = f"{age_in_days(name(self.column), as_of)} {'>=' if self.inclusive else '>'} {self.days}"
        if self.only is None:
            return stale
        column, values = self.only
        return f"{name(column)} IN ({literals(values)}) AND {stale}"


@dataclass(frozen=True)
class RequiredIf(RowCheck):
    """``column`` must not be null where ``when_column`` has the given value."""

    when_column: str
    when_value: str
    column: str

    def failing(self, as_of):
        return f"{name(self.when_column)} = {literal(self.when_value)} AND {name(self.column)} IS NULL"


@dataclass(frozen=True)
class Implies(RowCheck):
    """``when_column = when_value`` requires ``then_column = then_value``.

    With ``null_as_blank`` a missing second value fails; without it the SQL rule applies and a
    comparison with null decides nothing.
    """

    when_column: str
    when_value: str
    then_column: str
    then_value: str
    null_as_blank: bool = True

    def failing(self, as_of):
        when, then = name(self.when_column), name(self.then_column)
        if self.null_as_blank:
            return f"{stripped_equals(when, self.when_value)} AND NOT {stripped_equals(then, self.then_value)}"
        return f"{when} = {literal(self.when_value)} AND {then} <> {literal(self.then_value)}"


@dataclass(frozen=True)
class Matches(RowCheck):
    """The stripped value must match the pattern; null and blank fail."""

    column: str
    pattern: str

    def failing(self, as_of):
        c, p = name(self.column), literal(self.pattern)
        return f"NOT coalesce({c} RLIKE {p} OR {strip(c)} RLIKE {p}, false)"


@dataclass(frozen=True)
class NotPrefix(RowCheck):
    column: str
    prefix: str
    blank_fails: bool = False

    def failing(self, as_of):
        c, p = name(self.column), literal(self.prefix)
        bad = f"(contains({c}, {p}) AND startswith({strip(c)}, {p}))"
        return f"{bad} OR {is_blank(c)}" if self.blank_fails else bad


@dataclass(frozen=True)
class NotEqual(RowCheck):
    left: str
    right: str

    def failing(self, as_of):
        return f"{name(self.left)} = {name(self.right)}"


@dataclass(frozen=True)
class IsValue(RowCheck):
    """Condition for compound rules: fires where the column holds the value."""

    column: str
    value: str

    def failing(self, as_of):
        return f"{name(self.column)} = {literal(self.value)}"


@dataclass(frozen=True)
class IsOther(RowCheck):
    """Condition for compound rules: fires where the column holds another, non-null value."""

    column: str
    value: str

    def failing(self, as_of):
        return f"{name(self.column)} <> {literal(self.value)}"


@dataclass(frozen=True)
class AtLeast(RowCheck):
    """Condition for compound rules: fires where the number reaches the threshold."""

    column: str
    threshold: float

    def failing(self, as_of):
        value = parse_number(name(self.column))
        return f"({value} >= {self.threshold} AND NOT isnan({value}))"


@dataclass(frozen=True)
class AllOf(RowCheck):
    parts: tuple[RowCheck, ...]

    def failing(self, as_of):
        return "(" + " AND ".join(f"({p.failing(as_of)})" for p in self.parts) + ")"


@dataclass(frozen=True)
class AnyOf(RowCheck):
    parts: tuple[RowCheck, ...]

    def failing(self, as_of):
        return "(" + " OR ".join(f"({p.failing(as_of)})" for p in self.parts) + ")"


@dataclass(frozen=True)
class Expression(RowCheck):
    """A rule written as a Spark SQL condition that is true for failing rows."""

    sql: str

    def failing(self, as_of):
        return self.sql
