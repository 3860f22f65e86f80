"""The core pack: 27 rules over entities, issuers, hierarchy, KYC attributes and provider feed."""

from __future__ import annotations

from plumbline.functions.predicates import (
    Between, FreshWithin, InSet, NotEqual, NotFuture, NotNull, NotOverdue, RequiredIf,
)
from plumbline.model import Rule
from plumbline.operators.keys import ForeignKey, NoTwoCycle, UniqueKey
from plumbline.rules import vocabulary as v

ENTITIES = (
    Rule("ENT-001", "Completeness", "Critical", NotNull("entity_id"),
         "Each entity carries an identifier.", "Assign a master identifier at the source.",
         ("entity_id", "legal_name", "source_system")),
    Rule("ENT-002", "Uniqueness", "Critical", UniqueKey(("entity_id",)),
         "No two entity rows share an identifier.", "Merge the copies under a survivorship policy.",
         ("entity_id", "legal_name", "country_code", "source_system")),
    Rule("ENT-003", "Completeness", "High", NotNull("legal_name"),
         "Each entity has a legal name.", "Ask the owning source for the name.",
         ("entity_id", "legal_name", "source_system")),
    Rule("ENT-004", "Validity", "High", InSet("country_code", v.COUNTRIES),
         "The country is one of the supported codes.", "Map the code to the country list.",
         ("entity_id", "legal_name", "country_code", "source_system")),
    Rule("ENT-005", "Validity", "Medium", InSet("entity_type", v.ENTITY_TYPES),
         "The entity type belongs to the taxonomy.", "Map the type to the taxonomy.",
         ("entity_id", "legal_name", "entity_type")),
    Rule("ENT-006", "Validity", "Medium", InSet("status", v.ENTITY_STATUSES),
         "The status is a known one.", "Align status values between the sources.",
         ("entity_id", "legal_name", "status")),
    Rule("ENT-007", "Validity", "High", NotFuture("incorporation_date"),
         "The incorporation date has passed.", "Check the date with its source.",
         ("entity_id", "legal_name", "incorporation_date")),
    Rule("ENT-008", "Timeliness", "Medium",
         FreshWithin("last_verified_date", v.FRESH_DAYS, only=("status", ("Active",))),
         "Active entities were verified in the past year.", "Queue the stale entities for review.",
         ("entity_id", "legal_name", "status", "last_verified_date")),
    Rule("ENT-009", "Completeness", "Medium",
         RequiredIf("entity_type", "Private Company", "registration_number"),
         "Private companies have a registration number.", "Enrich the number from a registry.",
         ("entity_id", "legal_name", "entity_type", "registration_number")),
)

ISSUERS = (
    Rule("ISS-001", "Completeness", "Critical", NotNull("issuer_id"),
         "Each issuer carries an identifier.", "Assign an issuer identifier at the source.",
         ("issuer_id", "entity_id", "issuer_name")),
    Rule("ISS-002", "Uniqueness", "Critical", UniqueKey(("issuer_id",)),
         "No two issuer rows share an identifier.", "Find out which copy is right and drop the others.",
         ("issuer_id", "entity_id", "issuer_name")),
    Rule("ISS-003", "Referential Integrity", "Critical", ForeignKey("entity_id", "entities", "entity_id"),
         "The issuer's entity is in the master.", "Match the issuer to a master entity.",
         ("issuer_id", "entity_id", "issuer_name", "source_system")),
    Rule("ISS-004", "Validity", "Medium", InSet("instrument_type", v.ISSUER_INSTRUMENTS),
         "The instrument type is a known one.", "Map the type to the instrument list.",
         ("issuer_id", "entity_id", "instrument_type")),
    Rule("ISS-005", "Completeness", "High", RequiredIf("listing_status", "Listed", "exchange_code"),
         "Listed issuers name their exchange.", "Obtain the exchange code.",
         ("issuer_id", "entity_id", "listing_status", "exchange_code")),
)

HIERARCHY = (
    Rule("HIER-001", "Referential Integrity", "Critical", ForeignKey("child_entity_id", "entities", "entity_id"),
         "The child is in the entity master.", "Resolve the child before the hierarchy is released.",
         ("child_entity_id", "parent_entity_id", "source_system")),
    Rule("HIER-002", "Referential Integrity", "Critical", ForeignKey("parent_entity_id", "entities", "entity_id"),
         "The parent is in the entity master.", "Resolve the parent before the hierarchy is released.",
         ("child_entity_id", "parent_entity_id", "source_system")),
    Rule("HIER-003", "Validity", "High", NotEqual("child_entity_id", "parent_entity_id"),
         "No entity is its own parent.", "Delete the self-referencing edge.",
         ("child_entity_id", "parent_entity_id", "relationship_type")),
    Rule("HIER-004", "Validity", "High", Between("ownership_percentage", 0, 100),
         "Ownership lies between 0 and 100 percent.", "Check the stated ownership.",
         ("child_entity_id", "parent_entity_id", "ownership_percentage")),
    Rule("HIER-005", "Hierarchy Integrity", "High", NoTwoCycle("child_entity_id", "parent_entity_id"),
         "No two entities own each other.", "Decide which direction of the edge survives.",
         ("child_entity_id", "parent_entity_id", "relationship_type")),
)

KYC = (
    Rule("KYC-001", "Referential Integrity", "Critical", ForeignKey("entity_id", "entities", "entity_id"),
         "The reviewed entity is in the master.", "Create or match the missing master entity.",
         ("entity_id", "kyc_status", "risk_rating", "source_system")),
    Rule("KYC-002", "Validity", "High", InSet("risk_rating", v.ENTITY_RISK_RATINGS),
         "The risk rating is a known one.", "Map the rating to the risk scale.",
         ("entity_id", "risk_rating", "source_system")),
    Rule("KYC-003", "Timeliness", "Critical",
         FreshWithin("last_review_date", v.FRESH_DAYS, only=("risk_rating", ("High", "Critical"))),
         "High and critical risks were reviewed in the past year.", "Review the stale high risks first.",
         ("entity_id", "risk_rating", "last_review_date")),
    Rule("KYC-004", "Timeliness", "High", NotOverdue("next_review_due_date"),
         "The next review is not overdue.", "Start the overdue review.",
         ("entity_id", "risk_rating", "next_review_due_date")),
)

PROVIDER = (
    Rule("PRV-001", "Uniqueness", "High", UniqueKey(("provider_record_id",)),
         "No two provider rows share a record number.", "Ask the provider about the repeated record.",
         ("provider_record_id", "provider_name", "legal_name")),
    Rule("PRV-002", "Completeness", "High", NotNull("legal_name"),
         "Each provider row has a legal name.", "Return the row to the provider for enrichment.",
         ("provider_record_id", "provider_name", "legal_name")),
    Rule("PRV-003", "Validity", "Medium", Between("confidence_score", 0, 1),
         "The confidence lies between 0 and 1.", "Agree on the score format with the provider.",
         ("provider_record_id", "provider_name", "confidence_score")),
    Rule("PRV-004", "Consistency", "Medium",
         ForeignKey("registration_number", "entities", "registration_number", optional=True),
         "A given registration number is known to the master.", "Match the row to a master entity.",
         ("provider_record_id", "legal_name", "registration_number")),
)

CORE_PACK = {
    "entities": ENTITIES,
    "issuers": ISSUERS,
    "entity_hierarchy": HIERARCHY,
    "kyc_attributes": KYC,
    "provider_feed": PROVIDER,
}

# The column that names a record of each table.
CORE_KEYS = {
    "entities": "entity_id",
    "issuers": "issuer_id",
    "entity_hierarchy": "child_entity_id",
    "kyc_attributes": "entity_id",
    "provider_feed": "provider_record_id",
}
