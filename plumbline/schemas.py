"""Declared table schemas, as types after staging."""

from __future__ import annotations

from pyspark.sql import types as T

from plumbline.rules.trades import TRADE_COLUMNS


_TYPES = {"STRING": T.StringType(), "DATE": T.DateType(), "DOUBLE": T.DoubleType(), "BIGINT": T.LongType()}


def _schema(text: str) -> T.StructType:
    """A schema from ``name TYPE`` pairs, without needing a session."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(column, _TYPES[kind]) for column, kind in pairs])


# The columns of the five core tables.
ENTITIES = _schema("""
    entity_id STRING, legal_name STRING, normalized_name STRING, country_code STRING,
    registration_number STRING, entity_type STRING, sector STRING, industry STRING, status STRING,
    incorporation_date DATE, last_verified_date DATE, source_system STRING, created_at DATE, updated_at DATE
""")
ISSUERS = _schema("""
    issuer_id STRING, entity_id STRING, issuer_name STRING, instrument_type STRING, market STRING,
    listing_status STRING, exchange_code STRING, risk_country STRING, source_system STRING
""")
ENTITY_HIERARCHY = _schema("""
    child_entity_id STRING, parent_entity_id STRING, relationship_type STRING, ownership_percentage DOUBLE,
    effective_from DATE, effective_to DATE, source_system STRING
""")
KYC_ATTRIBUTES = _schema("""
    entity_id STRING, kyc_status STRING, risk_rating STRING, sanctions_flag STRING, pep_flag STRING,
    counterparty_type STRING, last_review_date DATE, next_review_due_date DATE, source_system STRING
""")
PROVIDER_FEED = _schema("""
    provider_record_id STRING, provider_name STRING, legal_name STRING, country_code STRING,
    registration_number STRING, sector STRING, status STRING, confidence_score DOUBLE, feed_date DATE
""")
# Trade links stay text: a bad value is something to report, not to lose at reading.
TRADE_LINKS = T.StructType([T.StructField(c, T.StringType()) for c in TRADE_COLUMNS])

TABLES = {
    "entities": ENTITIES,
    "issuers": ISSUERS,
    "entity_hierarchy": ENTITY_HIERARCHY,
    "kyc_attributes": KYC_ATTRIBUTES,
    "provider_feed": PROVIDER_FEED,
    "counterparty_trade_links": TRADE_LINKS,
}

# A feed event: an envelope around one provider record. The score is text until it is validated.
PAYLOAD = T.StructType(
    [T.StructField(f.name, T.StringType()) for f in PROVIDER_FEED.fields]
)
EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("sequence_number", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("payload", PAYLOAD),
])

# The manifest of a published run.
MANIFEST = _schema("run_id STRING, topic STRING, bootstrap_server STRING, published_count BIGINT, created_at STRING")


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns read as text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
