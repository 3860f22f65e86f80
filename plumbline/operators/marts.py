"""Stakeholder views and reporting marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.dates import as_of_sql
from plumbline.functions.predicates import Between, FreshWithin, InSet, NotEqual, NotNull, NotOverdue, RequiredIf
from plumbline.model import Rule
from plumbline.operators.evaluate import AsOf, wide_exceptions, union_all
from plumbline.operators.keys import ForeignKey
from plumbline.rules import vocabulary as v


def _failing(check, as_of):
    return F.expr(f"count_if({check.failed(as_of_sql(as_of))})")


STALE_ACTIVE = FreshWithin("last_verified_date", v.FRESH_DAYS, only=("status", ("Active",)))
STALE_HIGH_RISK = FreshWithin("last_review_date", v.FRESH_DAYS, only=("risk_rating", ("High", "Critical")))


def entity_quality_by_source(entities: DataFrame, as_of: AsOf = None, registration_name: str = "missing_registration_count") -> DataFrame:
    return entities.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("total_records"),
        _failing(NotNull("legal_name"), as_of).alias("missing_legal_name_count"),
        _failing(NotNull("registration_number"), as_of).alias(registration_name),
        _failing(InSet("country_code", v.COUNTRIES), as_of).alias("invalid_country_count"),
        _failing(STALE_ACTIVE, as_of).alias("stale_active_record_count"),
    )


def entity_quality_summary(entities: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The mart form of the same summary, with its own name for the registration column."""
    return entity_quality_by_source(entities, as_of, "missing_registration_number_count")


def kyc_review_risk(kyc: DataFrame, as_of: AsOf = None) -> DataFrame:
    return kyc.groupBy("risk_rating").agg(
        F.count(F.lit(1)).alias("total_records"),
        _failing(NotOverdue("next_review_due_date"), as_of).alias("overdue_review_count"),
        _failing(STALE_HIGH_RISK, as_of).alias("stale_high_risk_review_count"),
    )


def issuer_linkage(issuers: DataFrame, entities: DataFrame) -> DataFrame:
    """Linkage by source, counted over the join of issuers and entities.

    An entity id that occurs m times counts each of its issuers m times. Both sides are grouped by the
    key before they meet, and the multiplicity is applied to the counts, so the multiplied rows never
    exist and no key can be heavy in the join.
    """
    no_exchange = RequiredIf("listing_status", "Listed", "exchange_code").failed(as_of_sql(None))
    left = issuers.groupBy("entity_id", "source_system").agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"count_if({no_exchange}) AS no_exchange")
    )
    right = (
        entities.where(F.col("entity_id").isNotNull())
        .groupBy(F.col("entity_id").alias("known"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    times = F.coalesce("copies", F.lit(1))
    joined = left.join(right, F.col("entity_id") == F.col("known"), "left")
    return joined.groupBy("source_system").agg(
        F.sum(F.col("rows") * times).alias("total_issuer_records"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("rows"))), F.lit(0)).alias("orphan_issuer_count"),
        F.sum(F.col("no_exchange") * times).alias("listed_missing_exchange_count"),
    )


def hierarchy_exceptions(hierarchy: DataFrame) -> DataFrame:
    return hierarchy.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("total_relationships"),
        _failing(NotEqual("child_entity_id", "parent_entity_id"), None).alias("self_reference_count"),
        _failing(Between("ownership_percentage", 0, 100), None).alias("invalid_ownership_count"),
    )


def provider_feed_quality(provider: DataFrame) -> DataFrame:
    return provider.groupBy("provider_name").agg(
        F.count(F.lit(1)).alias("total_provider_records"),
        _failing(NotNull("legal_name"), None).alias("missing_legal_name_count"),
        _failing(Between("confidence_score", 0, 1), None).alias("invalid_confidence_score_count"),
    )


# The issues that the exceptions mart gathers, with the column that names the record.
MART_RULES = {
    "entities": ("entity_id", (
        Rule("MART-1", "Completeness", "High", NotNull("legal_name"), "", "", (), "Missing legal name"),
        Rule("MART-2", "Validity", "High", InSet("country_code", v.COUNTRIES), "", "", (), "Invalid country code"),
    )),
    "issuers": ("issuer_id", (
        Rule("MART-3", "Referential Integrity", "Critical", ForeignKey("entity_id", "entities", "entity_id"),
             "", "", (), "Issuer entity_id not found in entity master"),
    )),
    "kyc_attributes": ("entity_id", (
        Rule("MART-4", "Timeliness", "High", NotOverdue("next_review_due_date"), "", "", (), "Overdue KYC review"),
    )),
}


def quality_exceptions(tables: dict[str, DataFrame], as_of: AsOf = None) -> DataFrame:
    """Exceptions of entities, issuers and KYC in one shape; one scan per table and rule kind."""
    frames = []
    for name, (key, rules) in MART_RULES.items():
        with_source = tuple(
            Rule(r.rule_id, r.dimension, r.severity, r.check, r.description, r.recommendation,
                 ("source_system",), r.issue_type)
            for r in rules
        )
        hits = wide_exceptions(tables[name], with_source, key, tables, as_of)
        frames.append(hits.select(
            F.lit(name).alias("table_name"), "record_id", "issue_type", "severity", "source_system"))
    return union_all(frames)


def register_views(tables: dict[str, DataFrame], as_of: AsOf = None) -> dict[str, DataFrame]:
    """Create the five stakeholder views in the session and return them by name."""
    views = {
        "vw_entity_quality_by_source": entity_quality_by_source(tables["entities"], as_of),
        "vw_kyc_review_risk_summary": kyc_review_risk(tables["kyc_attributes"], as_of),
        "vw_issuer_linkage_summary": issuer_linkage(tables["issuers"], tables["entities"]),
        "vw_hierarchy_exception_summary": hierarchy_exceptions(tables["entity_hierarchy"]),
        "vw_provider_feed_quality_summary": provider_feed_quality(tables["provider_feed"]),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views
