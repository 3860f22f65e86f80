"""Date helpers. Every rule that depends on time takes an explicit as-of date."""

from __future__ import annotations

import datetime as dt


def as_of_sql(as_of: dt.date | str | None) -> str:
    """The as-of date as SQL; the current date when none is given."""
    return "current_date()" if as_of is None else f"DATE'{as_of}'"


def parse_date(c: str) -> str:
    """Text to date; null when it is not a date. Dates pass through unchanged."""
    return f"try_cast({c} AS DATE)"


def age_in_days(c: str, as_of: str) -> str:
    return f"datediff({as_of}, {parse_date(c)})"
