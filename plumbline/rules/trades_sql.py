"""The SQL pack: 18 rules whose conditions are Spark SQL texts selecting the failing rows."""

from __future__ import annotations

from dataclasses import dataclass

from plumbline.functions.numbers import parse_number
from plumbline.rules import vocabulary as v


@dataclass(frozen=True)
class SqlRule:
    """A rule as a SELECT of its failing rows.

    Rules given by ``columns`` and a row-local ``where`` can share one scan. A rule given as a
    whole ``query`` runs by itself.
    """

    rule_id: str
    severity: str
    dimension: str
    description: str
    recommendation: str
    columns: tuple[str, ...] = ()
    where: str = ""
    query: str = ""

    def sql(self, view: str) -> str:
        return self.query or f"SELECT {', '.join(self.columns)} FROM {view} WHERE {self.where}"


def _texts(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{x}'" for x in values)


def _blank(column: str) -> str:
    return f"coalesce(trim({column}), '') = ''"


def _listed(column: str, values: tuple[str, ...]) -> str:
    return f"coalesce({column} NOT IN ({_texts(values)}), true)"


def _date(column: str) -> str:
    return f"try_cast({column} AS date)"


def _number(column: str) -> str:
    return parse_number(column)


def trade_sql_rules(view: str = "counterparty_trade_links", as_of: str = "current_date()") -> tuple[SqlRule, ...]:
    """The pack for a view; ``as_of`` is a SQL date expression."""
    score = _number("provider_confidence_score")
    notional = _number("notional_amount")
    return (
        SqlRule("SQL_TRADE_001", "Critical", "Completeness", "Each trade has an identifier.",
                "Reject trades without identifier at the source.",
                ("trade_id", "counterparty_entity_id", "issuer_id", "source_system", "provider_name"),
                _blank("trade_id")),
        SqlRule("SQL_TRADE_002", "Critical", "Uniqueness", "No two trades share an identifier.",
                "Compare the copies between source systems.",
                query=f"""
                SELECT trade_id, counterparty_entity_id, issuer_id, source_system, provider_name
                FROM {view} LEFT SEMI JOIN (
                    SELECT trade_id AS repeated FROM {view}
                    WHERE NOT ({_blank('trade_id')}) GROUP BY trade_id HAVING count(*) > 1
                ) ON trade_id = repeated"""),
        SqlRule("SQL_CP_001", "High", "Completeness", "Each trade names its counterparty entity.",
                "Link the trade to a master entity.",
                ("trade_id", "counterparty_entity_id", "counterparty_name", "source_system", "provider_name"),
                _blank("counterparty_entity_id")),
        SqlRule("SQL_CP_002", "Medium", "Completeness", "The counterparty name says something.",
                "Take the name from trusted reference data.",
                ("trade_id", "counterparty_entity_id", "counterparty_name", "source_system"),
                f"{_blank('counterparty_name')} OR counterparty_name IN ({_texts(v.WEAK_NAMES)})"),
        SqlRule("SQL_ISSUER_001", "High", "Referential Integrity", "The issuer is given and not an orphan.",
                "Look the issuer up in the issuer master.",
                ("trade_id", "issuer_id", "issuer_name", "instrument_type", "source_system"),
                f"{_blank('issuer_id')} OR startswith(issuer_id, '{v.ORPHAN_ISSUER_PREFIX}')"),
        SqlRule("SQL_DATE_001", "High", "Validity", "The trade date is a date.", "Repair the trade date.",
                ("trade_id", "trade_date", "settlement_date", "source_system"),
                f"{_date('trade_date')} IS NULL"),
        SqlRule("SQL_DATE_002", "High", "Validity", "Settlement does not come before the trade.",
                "Check how the dates are mapped.",
                ("trade_id", "trade_date", "settlement_date", "source_system"),
                f"{_date('settlement_date')} < {_date('trade_date')}"),
        SqlRule("SQL_AMOUNT_001", "High", "Validity", "The notional is a positive number.",
                "Repair the notional.",
                ("trade_id", "counterparty_entity_id", "notional_amount", "currency", "source_system"),
                f"coalesce({notional} <= 0, true)"),
        SqlRule("SQL_REF_001", "High", "Validity", "The currency is a supported code.",
                "Map the currency to the code list.",
                ("trade_id", "currency", "notional_amount", "source_system"),
                _listed("currency", v.CURRENCIES)),
        SqlRule("SQL_REF_002", "High", "Validity", "The risk country is a supported code.",
                "Map the country to the code list.",
                ("trade_id", "counterparty_entity_id", "risk_country", "booking_country", "source_system"),
                _listed("risk_country", v.COUNTRIES)),
        SqlRule("SQL_REF_003", "Medium", "Validity", "The instrument type belongs to the taxonomy.",
                "Map the type to the taxonomy.",
                ("trade_id", "instrument_type", "instrument_id", "issuer_id"),
                _listed("instrument_type", v.TRADE_INSTRUMENTS)),
        SqlRule("SQL_KYC_001", "Critical", "Compliance", "High-risk counterparties have approved KYC.",
                "Finish KYC for these counterparties first.",
                ("trade_id", "counterparty_entity_id", "counterparty_name", "kyc_status",
                 "counterparty_risk_rating", "notional_amount", "currency"),
                "counterparty_risk_rating = 'High' AND kyc_status <> 'Approved'"),
        SqlRule("SQL_PROVIDER_001", "High", "Validity", "The provider's confidence lies between 0 and 1.",
                "Reject the score and check the feed.",
                ("trade_id", "provider_name", "provider_confidence_score", "source_system"),
                f"coalesce({score} NOT BETWEEN 0 AND 1, true)"),
        SqlRule("SQL_PROVIDER_002", "Medium", "Accuracy", "The provider's confidence reaches 0.70.",
                "Send the row to review or enrichment.",
                ("trade_id", "provider_name", "provider_confidence_score", "source_system"),
                f"{score} >= 0 AND {score} < {v.LOW_CONFIDENCE}"),
        SqlRule("SQL_SECURITY_001", "Medium", "Validity", "The ISIN has its 12-character form.",
                "Look the security up in instrument data.",
                ("trade_id", "issuer_id", "isin", "instrument_type"),
                f"coalesce(NOT rlike(isin, '{v.ISIN_PATTERN}'), true)"),
        SqlRule("SQL_ENTITY_001", "Medium", "Validity", "The LEI has its 20-character form.",
                "Look the entity up in the LEI index.",
                ("trade_id", "counterparty_entity_id", "lei", "counterparty_name"),
                f"coalesce(NOT rlike(lei, '{v.LEI_PATTERN}'), true)"),
        SqlRule("SQL_TIME_001", "Medium", "Timeliness", "Reference data was verified in the past year.",
                "Refresh the reference record.",
                ("trade_id", "counterparty_entity_id", "last_verified_date", "source_system"),
                f"{_date('last_verified_date')} < date_sub({as_of}, {v.FRESH_DAYS})"),
        SqlRule("SQL_REVIEW_001", "High", "Risk Review",
                "Large trades with a high-risk or unapproved counterparty were reviewed.",
                "Send the trade to compliance.",
                ("trade_id", "counterparty_entity_id", "counterparty_name", "notional_amount", "currency",
                 "kyc_status", "counterparty_risk_rating"),
                f"{notional} >= {v.LARGE_NOTIONAL:.0f} AND "
                "(counterparty_risk_rating = 'High' OR kyc_status <> 'Approved')"),
    )
