"""Standardise trade records, flag their issues, split them into accepted and quarantined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.numbers import percentage_sql
from plumbline.functions.predicates import (
    Between, DateOrder, Implies, InSet, NotBelow, NotBlank, NotPrefix, NotSentinel, PositiveNumber, ValidDate,
)
from plumbline.functions.text import literal, literals, name, replace_values, stripped_text
from plumbline.operators.keys import UniqueKey, failing_row_count, mark_rows
from plumbline.rules import vocabulary as v

DUPLICATE_FLAG = "duplicate_trade_id"
DUPLICATE = "__duplicate"

# The flags, in the order in which a record lists them. The duplicate flag is decided across rows.
FLAGS = {
    "missing_trade_id": NotBlank("trade_id"),
    DUPLICATE_FLAG: UniqueKey(("trade_id",), strip=True, ignore_blank=True),
    "missing_counterparty_entity_id": NotBlank("counterparty_entity_id"),
    "weak_counterparty_name": NotSentinel("counterparty_name", v.WEAK_NAMES),
    "invalid_or_orphan_issuer_id": NotPrefix("issuer_id", v.ORPHAN_ISSUER_PREFIX, blank_fails=True),
    "invalid_trade_date": ValidDate("trade_date"),
    "invalid_settlement_date": ValidDate("settlement_date"),
    "settlement_before_trade_date": DateOrder("trade_date", "settlement_date"),
    "invalid_notional_amount": PositiveNumber("notional_amount"),
    "invalid_currency": InSet("currency", v.CURRENCIES),
    "invalid_risk_country": InSet("risk_country", v.COUNTRIES),
    "invalid_instrument_type": InSet("instrument_type", v.TRADE_INSTRUMENTS),
    "invalid_kyc_status": InSet("kyc_status", v.TRADE_KYC_STATUSES),
    "invalid_counterparty_risk_rating": InSet("counterparty_risk_rating", v.TRADE_RISK_RATINGS),
    "high_risk_incomplete_kyc": Implies("counterparty_risk_rating", "High", "kyc_status", "Approved"),
    "invalid_provider_confidence_score": Between("provider_confidence_score", 0, 1),
    "low_provider_confidence_score": NotBelow("provider_confidence_score", v.LOW_CONFIDENCE),
}

# These two flags alone do not keep a record out of the accepted set.
NON_BLOCKING = ("weak_counterparty_name", "low_provider_confidence_score")

ACCEPTED = "accepted"
QUARANTINED = "quarantined_for_review"


def standardise(
    df: DataFrame,
    fixes: dict[str, dict[str, str]] | None = None,
) -> DataFrame:
    """Strip every text column, turn null texts into empty ones and correct obvious misspellings."""
    if fixes is None:
        fixes = {
            "currency": v.CURRENCY_FIXES,
            "risk_country": v.COUNTRY_FIXES,
            "booking_country": v.COUNTRY_FIXES,
            "instrument_type": v.INSTRUMENT_FIXES,
        }
    columns = []
    for field in df.schema.fields:
        c = name(field.name)
        if isinstance(field.dataType, T.StringType):
            c = replace_values(stripped_text(c), fixes.get(field.name, {}))
        columns.append(f"{c} AS {name(field.name)}")
    return df.selectExpr(*columns)


def standardised_marks(df: DataFrame) -> DataFrame:
    """Standardised rows with the duplicates marked.

    Keys are stripped either way, so the marks come first: the text columns of a row are standardised once, behind the
    decision whether it has to be looked up.
    """
    return standardise(mark_rows(df, FLAGS[DUPLICATE_FLAG], {}, DUPLICATE))


def flag_issues(df: DataFrame) -> DataFrame:
    """Add ``remediation_flags``, the issues of a record joined by ``;``, and ``issue_count``.

    ``df`` is standardised, or comes from ``standardised_marks``, which has looked for duplicates before.
    """
    marked = df if DUPLICATE in df.columns else mark_rows(df, FLAGS[DUPLICATE_FLAG], {}, DUPLICATE)
    df = df.drop(DUPLICATE)
    fired = []
    for flag, check in FLAGS.items():
        # No flag depends on the date.
        condition = DUPLICATE if flag == DUPLICATE_FLAG else check.failed("current_date()")
        fired.append(f"CASE WHEN {condition} THEN {literal(flag)} END")
    # Functions with a lambda, such as array_compact, would have Spark interpret all conditions instead of compiling them.
    listed = marked.selectExpr(*map(name, df.columns), f"concat_ws(';', {', '.join(fired)}) AS remediation_flags")
    count = "length(remediation_flags) - length(replace(remediation_flags, ';', '')) + 1"
    return listed.selectExpr("*", f"CASE WHEN remediation_flags = '' THEN 0 ELSE {count} END AS issue_count")


def decide(flagged: DataFrame) -> DataFrame:
    """Add ``curation_status`` and ``curated_at``; both outputs come from this one pass."""
    blocking = literals([f for f in FLAGS if f not in NON_BLOCKING])
    blocked = f"arrays_overlap(split(remediation_flags, ';'), array({blocking}))"
    return flagged.selectExpr(
        "*",
        f"CASE WHEN {blocked} THEN {literal(QUARANTINED)} ELSE {literal(ACCEPTED)} END AS curation_status",
        "current_timestamp() AS curated_at",
    )


def remediate(df: DataFrame) -> DataFrame:
    return decide(flag_issues(standardised_marks(df)))


def split(reviewed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The accepted and the quarantined records."""
    status = F.col("curation_status")
    return reviewed.where(status == ACCEPTED), reviewed.where(status == QUARANTINED)


def _local(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Standardised rows with one 0/1 column for each flag that a row decides alone, and the columns' names."""
    conditions = {f: c.failed("current_date()") for f, c in FLAGS.items() if f != DUPLICATE_FLAG}
    names = {f: f"__f{i}" for i, f in enumerate(conditions)}
    check = FLAGS[DUPLICATE_FLAG]
    rows = standardise(df).selectExpr(
        f"{check.keys()[0]} AS __key", f"{check.scope()} AS __in", *[f"CAST({conditions[f]} AS INT) AS {n}" for f, n in names.items()])
    return rows, names


def curation_counts(df: DataFrame) -> DataFrame:
    """The one row of ``reports.curation_summary`` of raw records, counted without joining anything to the rows.

    Rows that are in order by themselves are counted by key, which the map side combines; a repeated key turns them into
    duplicates.
    """
    rows, names = _local(df)
    blocking = [n for f, n in names.items() if f not in NON_BLOCKING]
    by_key = rows.groupBy("__key", "__in").agg(
        F.expr("count(*) AS __rows"), F.expr(f"count_if(greatest({', '.join(names.values())}) = 1) AS __issues"),
        F.expr(f"count_if(greatest({', '.join(blocking)}) = 1) AS __blocked"))
    twice = "__in AND __rows > 1"
    total = "coalesce(sum(__rows), 0L)"
    held = f"coalesce(sum(CASE WHEN {twice} THEN __rows ELSE __blocked END), 0L)"
    return by_key.agg(
        F.expr(f"{total} AS total_records"),
        F.expr(f"coalesce(sum(CASE WHEN {twice} THEN __rows ELSE __issues END), 0L) AS records_with_issues"),
        F.expr(f"{total} - {held} AS curated_records"),
        F.expr(f"{held} AS quarantine_records"),
        F.expr(f"{percentage_sql(f'({total} - {held})', total)} AS curated_rate_pct"),
        F.expr(f"{percentage_sql(held, total)} AS quarantine_rate_pct"),
    )


def flag_counts(df: DataFrame, n: int = 15) -> DataFrame:
    """The most frequent flags of raw records as in ``top_flags``: one aggregate for all flags and one for the duplicates."""
    rows, names = _local(df)
    sums = rows.agg(*[F.expr(f"coalesce(sum({c}), 0L) AS {c}") for c in names.values()])
    lines = ", ".join(f"{literal(f)}, {c}" for f, c in names.items())
    twins = failing_row_count(FLAGS[DUPLICATE_FLAG], standardise(df), {}).selectExpr(
        f"{literal(DUPLICATE_FLAG)} AS flag", "failed_count AS records")
    counted = sums.selectExpr(f"stack({len(names)}, {lines}) AS (flag, records)").unionByName(twins)
    return counted.where("records > 0").orderBy(F.desc("records"), "flag").limit(n)


def top_flags(flagged: DataFrame, n: int = 15) -> DataFrame:
    """The most frequent flags; ties in flag order."""
    one = flagged.where(F.col("issue_count") > 0).select(
        F.explode(F.split("remediation_flags", ";")).alias("flag")
    )
    counted = one.groupBy("flag").agg(F.count(F.lit(1)).alias("records"))
    return counted.orderBy(F.col("records").desc(), "flag").limit(n)
