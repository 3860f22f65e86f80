"""The onboarding pack: 18 rules for trade-linked counterparty records, after the schema rule."""

from __future__ import annotations

from plumbline.functions.predicates import (
    Between, DateOrder, FreshWithin, Implies, InSet, Matches, NotBelow, NotBlank, NotPrefix, NotSentinel,
    PositiveNumber, ValidDate,
)
from plumbline.model import DatasetSpec, Rule
from plumbline.operators.keys import UniqueKey
from plumbline.rules import vocabulary as v

# The columns that the incoming dataset has to have.
TRADE_COLUMNS = (
    "trade_id", "counterparty_entity_id", "counterparty_name", "issuer_id", "issuer_name",
    "instrument_type", "instrument_id", "isin", "trade_date", "settlement_date", "notional_amount",
    "currency", "risk_country", "booking_country", "exchange_mic", "kyc_status",
    "counterparty_risk_rating", "lei", "sector", "source_system", "provider_name",
    "provider_confidence_score", "ingestion_timestamp", "last_verified_date",
)

TRADES = DatasetSpec(
    name="counterparty_trade_links",
    path="incoming/counterparty_trade_links.csv",
    primary_key="trade_id",
    required_columns=TRADE_COLUMNS,
    date_columns=("trade_date", "settlement_date", "ingestion_timestamp", "last_verified_date"),
    numeric_columns=("notional_amount", "provider_confidence_score"),
    allowed_values={
        "currency": v.CURRENCIES,
        "kyc_status": v.TRADE_KYC_STATUSES,
        "counterparty_risk_rating": v.TRADE_RISK_RATINGS,
        "instrument_type": v.TRADE_INSTRUMENTS,
        "country_code": v.COUNTRIES,
    },
    description="Trade records linked to counterparties, issuers and instruments.",
)


def trade_rules(spec: DatasetSpec = TRADES) -> tuple[Rule, ...]:
    """The pack for a dataset of this shape, its value lists taken from the specification."""
    allowed = spec.allowed_values
    return (
        Rule("TRADE_001", "Completeness", "Critical", NotBlank("trade_id"),
             "Each trade has an identifier.", "Reject trades without identifier at the source.",
             ("trade_id", "source_system", "provider_name"), "Missing trade ID"),
        Rule("TRADE_002", "Uniqueness", "Critical", UniqueKey(("trade_id",), strip=True, ignore_blank=True),
             "No two trades share an identifier.", "Compare the copies between source systems.",
             ("trade_id", "counterparty_entity_id", "issuer_id", "source_system"), "Duplicate trade ID"),
        Rule("CP_001", "Completeness", "High", NotBlank("counterparty_entity_id"),
             "Each trade names its counterparty entity.", "Link the trade to a master entity.",
             ("trade_id", "counterparty_entity_id", "counterparty_name", "source_system"),
             "Missing counterparty entity ID"),
        Rule("CP_002", "Completeness", "Medium", NotSentinel("counterparty_name", v.WEAK_NAMES),
             "The counterparty name says something.", "Take the name from trusted reference data.",
             ("trade_id", "counterparty_entity_id", "counterparty_name"), "Missing or weak counterparty name"),
        Rule("ISSUER_001", "Completeness", "High", NotBlank("issuer_id"),
             "Each trade names its issuer.", "Link the instrument to an issuer.",
             ("trade_id", "issuer_id", "issuer_name", "instrument_type"), "Missing issuer ID"),
        Rule("ISSUER_002", "Referential Integrity", "High", NotPrefix("issuer_id", v.ORPHAN_ISSUER_PREFIX),
             "The issuer is not marked as orphan.", "Look the issuer up in the issuer master.",
             ("trade_id", "issuer_id", "issuer_name", "source_system"), "Orphan issuer reference"),
        Rule("DATE_001", "Validity", "High", ValidDate("trade_date"),
             "The trade date is a date.", "Repair the trade date.",
             ("trade_id", "trade_date", "settlement_date"), "Invalid trade date"),
        Rule("DATE_002", "Validity", "High", DateOrder("trade_date", "settlement_date"),
             "Settlement does not come before the trade.", "Check how the dates are mapped.",
             ("trade_id", "trade_date", "settlement_date", "source_system"), "Settlement date before trade date"),
        Rule("AMOUNT_001", "Validity", "High", PositiveNumber("notional_amount"),
             "The notional is a positive number.", "Repair the notional.",
             ("trade_id", "notional_amount", "currency"), "Invalid notional amount"),
        Rule("REF_001", "Validity", "High", InSet("currency", tuple(allowed["currency"]), strip=True),
             "The currency is a supported code.", "Map the currency to the code list.",
             ("trade_id", "currency", "notional_amount"), "Invalid currency"),
        Rule("REF_002", "Validity", "High", InSet("risk_country", tuple(allowed["country_code"]), strip=True),
             "The risk country is a supported code.", "Map the country to the code list.",
             ("trade_id", "counterparty_entity_id", "risk_country"), "Invalid risk country"),
        Rule("REF_003", "Validity", "Medium",
             InSet("instrument_type", tuple(allowed["instrument_type"]), strip=True),
             "The instrument type belongs to the taxonomy.", "Map the type to the taxonomy.",
             ("trade_id", "instrument_type", "instrument_id"), "Invalid instrument type"),
        Rule("KYC_001", "Compliance", "Critical",
             Implies("counterparty_risk_rating", "High", "kyc_status", "Approved"),
             "High-risk counterparties have approved KYC.", "Finish KYC for these counterparties first.",
             ("trade_id", "counterparty_entity_id", "kyc_status", "counterparty_risk_rating",
              "notional_amount", "currency"), "High-risk counterparty with incomplete KYC"),
        Rule("PROVIDER_001", "Validity", "High", Between("provider_confidence_score", 0, 1),
             "The provider's confidence lies between 0 and 1.", "Reject the score and check the feed.",
             ("trade_id", "provider_name", "provider_confidence_score"), "Invalid provider confidence score"),
        Rule("PROVIDER_002", "Accuracy", "Medium", NotBelow("provider_confidence_score", v.LOW_CONFIDENCE),
             "The provider's confidence reaches 0.70.", "Send the row to review or enrichment.",
             ("trade_id", "provider_name", "provider_confidence_score"), "Low provider confidence score"),
        Rule("SECURITY_001", "Validity", "Medium", Matches("isin", v.ISIN_PATTERN),
             "The ISIN has its 12-character form.", "Look the security up in instrument data.",
             ("trade_id", "issuer_id", "isin"), "Invalid ISIN pattern"),
        Rule("ENTITY_001", "Validity", "Medium", Matches("lei", v.LEI_PATTERN),
             "The LEI has its 20-character form.", "Look the entity up in the LEI index.",
             ("trade_id", "counterparty_entity_id", "lei"), "Invalid LEI pattern"),
        Rule("TIME_001", "Timeliness", "Medium", FreshWithin("last_verified_date", v.FRESH_DAYS, inclusive=True),
             "Reference data was verified in the past year.", "Refresh the reference record.",
             ("trade_id", "counterparty_entity_id", "last_verified_date"), "Stale reference verification"),
    )
