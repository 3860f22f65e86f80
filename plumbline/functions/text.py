"""Text helpers as SQL expressions: stripping, blank tests, entity-name normalisation.

Rules are compiled to SQL text rather than to chains of column calls: a rule pack then reaches the
planner in a few calls, and every rule can be read and logged as it runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Legal-form words dropped when entity names are compared.
LEGAL_FORM_WORDS = (
    "LIMITED", "LTD", "PLC", "INC", "CORP", "CORPORATION",
    "LLC", "HOLDINGS", "GROUP",
)


def literal(text: str | None) -> str:
    """A SQL text literal."""
    if text is None:
        return "CAST(NULL AS STRING)"
    escaped = "".join(
        {"\\": "\\\\", "'": "\\'", "\n": "\\n", "\r": "\\r", "\t": "\\t"}.get(
            ch, ch if " " <= ch <= "~" or ch > "\uffff" else f"\\u{ord(ch):04x}"
        )
        for ch in text
    )
    return f"'{escaped}'"


def literals(values: tuple[str, ...] | list[str]) -> str:
    return ", ".join(literal(v) for v in values)


def name(column: str) -> str:
    """A quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def starts_plain(c: str) -> str:
    """True when the first character is printable ASCII and no space: two byte comparisons."""
    return f"({c} >= '!' AND {c} < '\\u007f')"


def strip(c: str) -> str:
    """Remove white space of any kind at both ends (SQL ``trim`` removes spaces only).

    Trimming a set of characters is costly, so values that plainly need none are passed through.
    """
    clean = f"{starts_plain(c)} AND {starts_plain(f'substr({c}, -1)')}"
    return f"(CASE WHEN {clean} THEN {c} ELSE btrim({c}, {literal(WHITESPACE)}) END)"


def stripped_text(c: str) -> str:
    """The value as stripped text, null becoming the empty text."""
    return f"coalesce({strip(c)}, '')"


def is_blank(c: str) -> str:
    """True for null, empty and white-space-only values."""
    return f"({c} IS NULL OR (NOT {starts_plain(c)} AND btrim({c}, {literal(WHITESPACE)}) = ''))"


def stripped_equals(c: str, value: str) -> str:
    """Whether the stripped value equals a non-empty text; null is not equal to it."""
    v = literal(value)
    return f"coalesce({c} = {v} OR (contains({c}, {v}) AND {strip(c)} = {v}), false)"


def stripped_in(c: str, values: tuple[str, ...] | list[str]) -> str:
    """Whether the stripped value is one of the texts; null is none of them."""
    listed = literals(values)
    return f"coalesce({c} IN ({listed}) OR {strip(c)} IN ({listed}), false)"


def normalise_name(c: str) -> Column:
    """Comparable form of an entity name: upper case, no punctuation, no legal-form words."""
    words = literal(r"\b(" + "|".join(LEGAL_FORM_WORDS) + r")\b")
    plain = f"regexp_replace(upper({name(c)}), '[^A-Z0-9 ]', ' ')"
    return F.expr(f"trim(regexp_replace(regexp_replace({plain}, {words}, ' '), ' +', ' '))")


def replace_values(c: str, mapping: dict[str, str]) -> str:
    """Exact-value replacement; values outside the mapping stay as they are."""
    if not mapping:
        return c
    arms = " ".join(f"WHEN {literal(wrong)} THEN {literal(right)}" for wrong, right in mapping.items())
    return f"(CASE {c} {arms} ELSE {c} END)"
