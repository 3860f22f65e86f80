"""Number helpers: rounding, guarded rates, tolerant parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even_sql(c: str, places: int) -> str:
    """Round half to even on the scaled value, the rule of array libraries.

    Spark's ``round`` is half-up and ``bround`` works on the decimal text, so neither gives
    the same last digit as the scaled form on ties such as 98.505.
    """
    scale = f"{10 ** places}.0D"
    return f"(rint(({c}) * {scale}) / {scale})"


def percentage_sql(part: str, whole: str, places: int = 2) -> str:
    """``part / whole * 100`` rounded, and 0 where there are no rows."""
    ratio = f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100.0D"
    return f"(CASE WHEN {whole} = 0 THEN 0.0D ELSE {round_even_sql(ratio, places)} END)"


def exact_mean_sql(c: str, places: int) -> str:
    """Mean of values known to have ``places`` decimals.

    The sum runs over decimals, so the result does not depend on the order in which partial
    sums arrive from the shuffle.
    """
    return f"(CAST(sum(CAST({c} AS DECIMAL(18,{places}))) AS DOUBLE) / CAST(count({c}) AS DOUBLE))"


def round_even(c: str, places: int) -> Column:
    return F.expr(round_even_sql(c, places))


def percentage(part: str, whole: str, places: int = 2) -> Column:
    return F.expr(percentage_sql(part, whole, places))


def parse_number(c: str) -> str:
    """Text to double; null when it is not a number. NaN is left for the caller to treat as missing.

    A trailing ``d`` or ``f`` is a JVM literal suffix rather than part of a number.
    """
    text = f"rtrim(CAST({c} AS STRING))"
    suffix = " OR ".join(f"endswith({text}, '{x}')" for x in "dDfF")
    return f"(CASE WHEN ({suffix}) AND NOT {text} RLIKE '(?i)inf$' THEN NULL ELSE try_cast({c} AS DOUBLE) END)"


def nan_to_null(c: str) -> str:
    return f"(CASE WHEN NOT isnan({c}) THEN {c} END)"
