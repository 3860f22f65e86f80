"""Listing packs: plain result sets of failing records, one per question."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.dates import as_of_sql
from plumbline.functions.predicates import (
    AnyOf, Between, FreshWithin, InSet, NotBelow, NotBlank, NotEqual, NotNull, NotOverdue, RequiredIf, RowCheck,
)
from plumbline.operators.evaluate import AsOf
from plumbline.operators.keys import fan_out_left_join
from plumbline.rules import vocabulary as v

Tables = dict[str, DataFrame]

STALE_ACTIVE = FreshWithin("last_verified_date", v.FRESH_DAYS, only=("status", ("Active",)))


def failing_rows(df: DataFrame, check: RowCheck, columns: tuple[str, ...], as_of: AsOf = None) -> DataFrame:
    return df.where(check.failed(as_of_sql(as_of))).select(*columns)


def repeated_keys(df: DataFrame, key: str, count_name: str) -> DataFrame:
    """Keys that occur more than once; a repeated missing key is one of them."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def missing_count(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias(name))


def without_master(df: DataFrame, key: str, master: DataFrame, master_key: str, columns: tuple[str, ...]) -> DataFrame:
    """Rows whose key is missing or unknown to the master."""
    known = master.select(F.col(master_key).alias("__known")).where("__known IS NOT NULL").distinct()
    return df.select(*columns).join(known, F.col(key) == F.col("__known"), "left_anti")


def overdue_with_name(t: Tables, as_of: AsOf = None) -> DataFrame:
    """Overdue KYC reviews with the entity's name; an id with several entity rows is listed for each."""
    overdue = failing_rows(
        t["kyc_attributes"], NotOverdue("next_review_due_date"),
        ("entity_id", "kyc_status", "risk_rating", "next_review_due_date"), as_of,
    )
    named = fan_out_left_join(overdue, t["entities"].select("entity_id", "legal_name"), "entity_id")
    return named.select("entity_id", "legal_name", "kyc_status", "risk_rating", "next_review_due_date")


# Each listing takes the tables and the as-of date.
ENTITY_LISTINGS = {
    "duplicate_entity_ids": lambda t, d: repeated_keys(t["entities"], "entity_id", "duplicate_count"),
    "blank_legal_names": lambda t, d: failing_rows(
        t["entities"], NotBlank("legal_name"),
        ("entity_id", "source_system", "country_code", "registration_number")),
    "invalid_countries": lambda t, d: failing_rows(
        t["entities"], InSet("country_code", v.COUNTRIES),
        ("entity_id", "legal_name", "country_code", "source_system")),
    "stale_active_entities": lambda t, d: failing_rows(
        t["entities"], STALE_ACTIVE,
        ("entity_id", "legal_name", "status", "last_verified_date", "source_system"), d),
    "unlinked_issuers": lambda t, d: without_master(
        t["issuers"], "entity_id", t["entities"], "entity_id",
        ("issuer_id", "entity_id", "issuer_name", "market", "risk_country")),
    "bad_hierarchy_edges": lambda t, d: failing_rows(
        t["entity_hierarchy"],
        AnyOf((NotEqual("child_entity_id", "parent_entity_id"),
               Between("ownership_percentage", 0, 100, null_fails=False))),
        ("child_entity_id", "parent_entity_id", "relationship_type", "ownership_percentage")),
    "overdue_kyc_with_name": overdue_with_name,
    "low_confidence_records": lambda t, d: failing_rows(
        t["provider_feed"], NotBelow("confidence_score", v.LOW_CONFIDENCE, low=None, null_fails=True),
        ("provider_record_id", "provider_name", "legal_name", "country_code", "confidence_score", "feed_date")),
}

RULE_LISTINGS = {
    "entity_id_counts": lambda t, d: repeated_keys(t["entities"], "entity_id", "record_count"),
    "missing_name_count": lambda t, d: missing_count(t["entities"], "legal_name", "missing_legal_name_count"),
    "invalid_country_codes": ENTITY_LISTINGS["invalid_countries"],
    "invalid_entity_types": lambda t, d: failing_rows(
        t["entities"], InSet("entity_type", v.ENTITY_TYPES), ("entity_id", "legal_name", "entity_type")),
    "stale_active": lambda t, d: failing_rows(
        t["entities"], STALE_ACTIVE, ("entity_id", "legal_name", "status", "last_verified_date"), d),
    "orphan_issuers": lambda t, d: without_master(
        t["issuers"], "entity_id", t["entities"], "entity_id",
        ("issuer_id", "entity_id", "issuer_name", "source_system")),
    "listed_without_exchange": lambda t, d: failing_rows(
        t["issuers"], RequiredIf("listing_status", "Listed", "exchange_code"),
        ("issuer_id", "entity_id", "issuer_name", "listing_status", "exchange_code")),
    "orphan_children": lambda t, d: without_master(
        t["entity_hierarchy"], "child_entity_id", t["entities"], "entity_id",
        ("child_entity_id", "parent_entity_id", "relationship_type", "source_system")),
    "orphan_parents": lambda t, d: without_master(
        t["entity_hierarchy"], "parent_entity_id", t["entities"], "entity_id",
        ("child_entity_id", "parent_entity_id", "relationship_type", "source_system")),
    "self_references": lambda t, d: failing_rows(
        t["entity_hierarchy"], NotEqual("child_entity_id", "parent_entity_id"),
        ("child_entity_id", "parent_entity_id", "relationship_type")),
    "invalid_ownership": lambda t, d: failing_rows(
        t["entity_hierarchy"], Between("ownership_percentage", 0, 100),
        ("child_entity_id", "parent_entity_id", "ownership_percentage")),
    "orphan_kyc": lambda t, d: without_master(
        t["kyc_attributes"], "entity_id", t["entities"], "entity_id",
        ("entity_id", "kyc_status", "risk_rating", "source_system")),
    "invalid_risk_ratings": lambda t, d: failing_rows(
        t["kyc_attributes"], InSet("risk_rating", v.ENTITY_RISK_RATINGS),
        ("entity_id", "risk_rating", "source_system")),
    "overdue_kyc": lambda t, d: failing_rows(
        t["kyc_attributes"], NotOverdue("next_review_due_date"),
        ("entity_id", "risk_rating", "next_review_due_date"), d),
    "stale_high_risk": lambda t, d: failing_rows(
        t["kyc_attributes"],
        FreshWithin("last_review_date", v.FRESH_DAYS, only=("risk_rating", ("High", "Critical"))),
        ("entity_id", "risk_rating", "last_review_date"), d),
    "duplicate_provider_records": lambda t, d: repeated_keys(t["provider_feed"], "provider_record_id", "record_count"),
    "provider_without_name": lambda t, d: failing_rows(
        t["provider_feed"], NotNull("legal_name"), ("provider_record_id", "provider_name", "legal_name")),
    "invalid_confidence": lambda t, d: failing_rows(
        t["provider_feed"], Between("confidence_score", 0, 1),
        ("provider_record_id", "provider_name", "confidence_score")),
}
