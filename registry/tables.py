"""Listings, joins, views, marts, profiles, remediation and staging."""

from __future__ import annotations

from plumbline.functions.text import normalise_name
from plumbline.operators import listings, marts, profiling, remediation, reports, sketches
from plumbline.operators.evaluate import union_all
from registry.domain import AS_OF, CORE_TABLES, base_table, domain_table
from plumbline.schemas import TABLES
from plumbline.session import fresh_path
from plumbline.sources.tables import stage
from registry.base import AS_OF_SQL, TRADE_TABLE, Query, core, trades, with_tables
from registry.conditions import COUNTRY_LIST

STALE_BEFORE = f"({AS_OF_SQL} - INTERVAL 365 DAY)"

LISTING_SQL = {
    "duplicate_entity_ids": "SELECT entity_id, count(*) AS duplicate_count FROM entities GROUP BY ALL HAVING duplicate_count > 1",
    "blank_legal_names": "SELECT entity_id, source_system, country_code, registration_number FROM entities "
                         "WHERE coalesce(trim(legal_name), '') = ''",
    "invalid_countries": "SELECT entity_id, legal_name, country_code, source_system FROM entities "
                         f"WHERE coalesce(country_code, '?') NOT IN {COUNTRY_LIST}",
    "stale_active_entities": "SELECT entity_id, legal_name, status, last_verified_date, source_system FROM entities "
                             f"WHERE status = 'Active' AND last_verified_date < {STALE_BEFORE}",
    "unlinked_issuers": "SELECT issuer_id, entity_id, issuer_name, market, risk_country FROM issuers "
                        "ANTI JOIN entities USING (entity_id)",
    "bad_hierarchy_edges": "SELECT child_entity_id, parent_entity_id, relationship_type, ownership_percentage "
                           "FROM entity_hierarchy WHERE child_entity_id = parent_entity_id "
                           "OR ownership_percentage NOT BETWEEN 0 AND 100",
    "overdue_kyc_with_name": "SELECT k.entity_id, e.legal_name, k.kyc_status, k.risk_rating, k.next_review_due_date "
                             "FROM kyc_attributes k LEFT JOIN entities e USING (entity_id) "
                             f"WHERE k.next_review_due_date < {AS_OF_SQL}",
    "low_confidence_records": "SELECT provider_record_id, provider_name, legal_name, country_code, confidence_score, feed_date "
                              "FROM provider_feed WHERE coalesce(confidence_score, 0) < 0.7",
    "entity_id_counts": "SELECT entity_id, count(*) AS record_count FROM entities GROUP BY ALL HAVING record_count > 1",
    "missing_name_count": "SELECT count(*) - count(legal_name) AS missing_legal_name_count FROM entities",
    "invalid_country_codes": "SELECT entity_id, legal_name, country_code, source_system FROM entities "
                             f"WHERE country_code IS NULL OR NOT (country_code IN {COUNTRY_LIST})",
    "invalid_entity_types": "SELECT entity_id, legal_name, entity_type FROM entities WHERE coalesce(entity_type, '?') NOT IN "
                            "('Public Company','Private Company','Fund','SPV','Government Entity','Financial Institution')",
    "stale_active": "SELECT entity_id, legal_name, status, last_verified_date FROM entities "
                    f"WHERE status = 'Active' AND last_verified_date < {STALE_BEFORE}",
    "orphan_issuers": "SELECT issuer_id, entity_id, issuer_name, source_system FROM issuers ANTI JOIN entities USING (entity_id)",
    "listed_without_exchange": "SELECT issuer_id, entity_id, issuer_name, listing_status, exchange_code FROM issuers "
                               "WHERE listing_status = 'Listed' AND exchange_code IS NULL",
    "orphan_children": "SELECT child_entity_id, parent_entity_id, relationship_type, source_system FROM entity_hierarchy h "
                       "ANTI JOIN entities e ON h.child_entity_id = e.entity_id",
    "orphan_parents": "SELECT child_entity_id, parent_entity_id, relationship_type, source_system FROM entity_hierarchy h "
                      "ANTI JOIN entities e ON h.parent_entity_id = e.entity_id",
    "self_references": "SELECT child_entity_id, parent_entity_id, relationship_type FROM entity_hierarchy "
                       "WHERE child_entity_id = parent_entity_id",
    "invalid_ownership": "SELECT child_entity_id, parent_entity_id, ownership_percentage FROM entity_hierarchy "
                         "WHERE coalesce(ownership_percentage NOT BETWEEN 0 AND 100, true)",
    "orphan_kyc": "SELECT entity_id, kyc_status, risk_rating, source_system FROM kyc_attributes ANTI JOIN entities USING (entity_id)",
    "invalid_risk_ratings": "SELECT entity_id, risk_rating, source_system FROM kyc_attributes "
                            "WHERE coalesce(risk_rating, '?') NOT IN ('Low','Medium','High','Critical')",
    "overdue_kyc": "SELECT entity_id, risk_rating, next_review_due_date FROM kyc_attributes "
                   f"WHERE next_review_due_date < {AS_OF_SQL}",
    "stale_high_risk": "SELECT entity_id, risk_rating, last_review_date FROM kyc_attributes "
                       f"WHERE risk_rating IN ('High','Critical') AND last_review_date < {STALE_BEFORE}",
    "duplicate_provider_records": "SELECT provider_record_id, count(*) AS record_count FROM provider_feed GROUP BY ALL "
                                  "HAVING record_count > 1",
    "provider_without_name": "SELECT provider_record_id, provider_name, legal_name FROM provider_feed WHERE legal_name IS NULL",
    "invalid_confidence": "SELECT provider_record_id, provider_name, confidence_score FROM provider_feed "
                          "WHERE coalesce(confidence_score NOT BETWEEN 0 AND 1, true)",
}


def _listing(make):
    return lambda spark, folder: make(core(spark, folder), AS_OF)


_VIEW_ENTITY = f"""
    SELECT source_system, count(*) AS total_records, count(*) - count(legal_name) AS missing_legal_name_count,
           count(*) - count(registration_number) AS {{registration}},
           count(*) FILTER (coalesce(country_code, '?') NOT IN {COUNTRY_LIST}) AS invalid_country_count,
           count(*) FILTER (status = 'Active' AND last_verified_date < {STALE_BEFORE}) AS stale_active_record_count
    FROM entities GROUP BY source_system"""

VIEW_SQL = {
    "agg9_entity_quality_by_source": _VIEW_ENTITY.format(registration="missing_registration_count"),
    "mart_entity_quality_summary": _VIEW_ENTITY.format(registration="missing_registration_number_count"),
    "agg10_kyc_review_risk": f"""
        SELECT risk_rating, count(*) AS total_records,
               count(*) FILTER (next_review_due_date < {AS_OF_SQL}) AS overdue_review_count,
               count(*) FILTER (risk_rating IN ('High','Critical') AND last_review_date < {STALE_BEFORE})
                   AS stale_high_risk_review_count
        FROM kyc_attributes GROUP BY risk_rating""",
    "agg11_issuer_linkage": """
        SELECT i.source_system, count(*) AS total_issuer_records,
               count(*) FILTER (e.entity_id IS NULL) AS orphan_issuer_count,
               count(*) FILTER (i.listing_status = 'Listed' AND i.exchange_code IS NULL) AS listed_missing_exchange_count
        FROM issuers i LEFT JOIN entities e ON e.entity_id = i.entity_id GROUP BY 1""",
    "agg12_hierarchy_exceptions": """
        SELECT source_system, count(*) AS total_relationships,
               count(*) FILTER (child_entity_id = parent_entity_id) AS self_reference_count,
               count(*) FILTER (coalesce(ownership_percentage NOT BETWEEN 0 AND 100, true)) AS invalid_ownership_count
        FROM entity_hierarchy GROUP BY 1""",
    "agg13_provider_feed_quality": """
        SELECT provider_name, count(*) AS total_provider_records, count(*) - count(legal_name) AS missing_legal_name_count,
               count(*) FILTER (coalesce(confidence_score NOT BETWEEN 0 AND 1, true)) AS invalid_confidence_score_count
        FROM provider_feed GROUP BY 1""",
}

_VIEW_RUNS = {
    "agg9_entity_quality_by_source": lambda t: marts.entity_quality_by_source(t["entities"], AS_OF),
    "mart_entity_quality_summary": lambda t: marts.entity_quality_summary(t["entities"], AS_OF),
    "agg10_kyc_review_risk": lambda t: marts.kyc_review_risk(t["kyc_attributes"], AS_OF),
    "agg11_issuer_linkage": lambda t: marts.issuer_linkage(t["issuers"], t["entities"]),
    "agg12_hierarchy_exceptions": lambda t: marts.hierarchy_exceptions(t["entity_hierarchy"]),
    "agg13_provider_feed_quality": lambda t: marts.provider_feed_quality(t["provider_feed"]),
}


def _view(make):
    return lambda spark, folder: make(core(spark, folder))


MART_EXCEPTIONS_STEP = f"""
    SELECT 'entities' AS table_name, entity_id AS record_id, 'Missing legal name' AS issue_type, 'High' AS severity, source_system
    FROM entities WHERE legal_name IS NULL
    UNION ALL SELECT 'entities', entity_id, 'Invalid country code', 'High', source_system FROM entities
    WHERE coalesce(country_code, '?') NOT IN {COUNTRY_LIST}
    UNION ALL SELECT 'issuers', issuer_id, 'Issuer entity_id not found in entity master', 'Critical', source_system
    FROM issuers i WHERE NOT EXISTS (SELECT 1 FROM entities e WHERE e.entity_id = i.entity_id)
    UNION ALL SELECT 'kyc_attributes', entity_id, 'Overdue KYC review', 'High', source_system
    FROM kyc_attributes WHERE next_review_due_date < {AS_OF_SQL}"""


# Profiles

_TRADE_FIELDS = [*(x.name for x in TABLES[TRADE_TABLE].fields), "batch_no"]

SPARK_TYPES = {"entities": {"incorporation_date": "date", "last_verified_date": "date", "created_at": "date", "updated_at": "date"},
               "provider_feed": {"confidence_score": "double", "feed_date": "date"},
               "issuers": {}, "entity_hierarchy": {"ownership_percentage": "double", "effective_from": "date", "effective_to": "date"},
               "kyc_attributes": {"last_review_date": "date", "next_review_due_date": "date"}}


def _profile(spark, folder):
    t = core(spark, folder)
    return union_all([
        profiling.top_values_text(profiling.profile(t[n], n)) for n in CORE_TABLES
    ])


def _profile_column_sql(table: str, column: str, dtype: str) -> str:
    shown = f"coalesce(CAST({column} AS VARCHAR), 'nan')"
    pct = "CASE WHEN count(*) = 0 THEN 0.0::DOUBLE ELSE CAST(round_even({0}::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE, 2) AS DOUBLE) END"
    missing, unique = f"(count(*) - count({column}))", f"count(DISTINCT {column})"
    top = (f"(SELECT string_agg(v || ': ' || n, ', ' ORDER BY n DESC, v) FROM (SELECT {shown} AS v, count(*) AS n "
           f"FROM {table} GROUP BY 1 ORDER BY n DESC, v LIMIT 5))")
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS row_count, {missing} AS missing_count, "
            f"{pct.format(missing)} AS missing_pct, {unique} AS unique_count, {pct.format(unique)} AS unique_pct, "
            f"'{dtype}' AS dtype, {top} AS top_values FROM {table}")


_PROFILE_SQL = with_tables(CORE_TABLES, "\nUNION ALL\n".join(
    _profile_column_sql(t, f.name, SPARK_TYPES[t].get(f.name, "string"))
    for t in CORE_TABLES for f in TABLES[t].fields
))


def _sketched_profile(spark, folder):
    """Events sketched by day; the last day is added from its own rows. The merged profile is held against a scan of all."""
    events, path = base_table(spark, folder, "events"), fresh_path(spark, "sketches")
    day = "date_format(ts, 'yyyy-MM-dd')"
    last = events.selectExpr(f"max({day}) AS last").first()["last"]
    sketches.keep(sketches.sketch(events.where(f"NOT {day} <=> '{last}'"), day), path)
    sketches.keep(sketches.sketch(events.where(f"{day} = '{last}'"), day), path)
    return sketches.audited(sketches.merged_profile(sketches.kept(spark, path), "events"), events)


_SKETCHED_SQL = "\nUNION ALL\n".join(
    f"SELECT 'events' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS missing_count, "
    f"count(DISTINCT {c}) AS unique_count, true AS counts_equal, true AS unique_in_bound, true AS top_in_bound FROM events"
    for c in ("event_id", "ts", "user_id", "event_type", "value", "props"))


def _onboarding_profile(spark, folder):
    return profiling.onboarding_profile(trades(spark, folder), TRADE_TABLE, "trade_id")


def _onboarding_column_sql(column: str) -> str:
    missing = f"(count(*) - count({column}))"
    blank = f"count(*) FILTER (trim(coalesce({column}, '')) = '')"
    both = f"({missing} + {blank})"
    order = ", ".join(["trade_id NULLS LAST", *[f"{x} NULLS FIRST" for x in _TRADE_FIELDS]])
    samples = (f"(SELECT coalesce(string_agg({column}, ' | ' ORDER BY place), '') FROM (SELECT {column}, row_number() OVER (ORDER BY {order}) "
               f"AS place FROM {TRADE_TABLE} WHERE {column} IS NOT NULL QUALIFY place <= 5))")
    return (f"SELECT '{TRADE_TABLE}' AS dataset_name, '{column}' AS column_name, 'string' AS dtype, count(*) AS total_rows, "
            f"{missing} AS missing_count, {blank} AS blank_count, {both} AS missing_or_blank_count, "
            f"CAST(round_even({both}::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE, 2) AS DOUBLE) AS missing_or_blank_pct, "
            f"{blank} AS missing_or_blank_distinct, count(DISTINCT {column}) AS distinct_count, {samples} AS sample_values "
            f"FROM {TRADE_TABLE}")


_ONBOARDING_SQL = with_tables([TRADE_TABLE], "\nUNION ALL\n".join(
    _onboarding_column_sql(f) for f in [*(x.name for x in TABLES[TRADE_TABLE].fields), "batch_no"]
))


def _win3(spark, folder):
    return profiling.top_values(trades(spark, folder).select("currency", "kyc_status", "instrument_type"))


_WIN3_SQL = with_tables([TRADE_TABLE], f"""
    SELECT column_name, value, rows, place::INTEGER AS place FROM (
        SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY rows DESC, value) AS place FROM (
            SELECT 'currency' AS column_name, coalesce(currency, 'nan') AS value, count(*) AS rows FROM {TRADE_TABLE} GROUP BY ALL
            UNION ALL SELECT 'kyc_status', coalesce(kyc_status, 'nan'), count(*) FROM {TRADE_TABLE} GROUP BY ALL
            UNION ALL SELECT 'instrument_type', coalesce(instrument_type, 'nan'), count(*) FROM {TRADE_TABLE} GROUP BY ALL))
    WHERE place <= 5""")

# Remediation

_FIX = {
    "currency": "CASE trim(coalesce(currency, '')) WHEN 'EURO' THEN 'EUR' WHEN 'US' THEN 'USD' WHEN 'U.S.D' THEN 'USD' "
                "WHEN 'UKP' THEN 'GBP' ELSE trim(coalesce(currency, '')) END",
    "risk_country": "CASE trim(coalesce(risk_country, '')) WHEN 'UK' THEN 'GB' ELSE trim(coalesce(risk_country, '')) END",
    "booking_country": "CASE trim(coalesce(booking_country, '')) WHEN 'UK' THEN 'GB' ELSE trim(coalesce(booking_country, '')) END",
    "instrument_type": "CASE trim(coalesce(instrument_type, '')) WHEN 'Equityy' THEN 'Equity' ELSE trim(coalesce(instrument_type, '')) END",
}
_CLEAN_STEP = ("cleaned", "SELECT " + ", ".join(
    f"{_FIX.get(f, f'trim(coalesce({f}, {chr(39)}{chr(39)}))')} AS {f}" for f in _TRADE_FIELDS) + f" FROM {TRADE_TABLE}")

_SCORE = "try_cast(provider_confidence_score AS DOUBLE)"
_FLAG_SQL = [
    ("missing_trade_id", "trade_id = ''"),
    ("duplicate_trade_id", "trade_id <> '' AND count(*) OVER (PARTITION BY trade_id) > 1"),
    ("missing_counterparty_entity_id", "counterparty_entity_id = ''"),
    ("weak_counterparty_name", "counterparty_name IN ('', 'Unknown Counterparty')"),
    ("invalid_or_orphan_issuer_id", "issuer_id = '' OR issuer_id LIKE 'ISS-ORPHAN%'"),
    ("invalid_trade_date", "try_cast(trade_date AS DATE) IS NULL"),
    ("invalid_settlement_date", "try_cast(settlement_date AS DATE) IS NULL"),
    ("settlement_before_trade_date", "try_cast(settlement_date AS DATE) < try_cast(trade_date AS DATE)"),
    ("invalid_notional_amount", "coalesce(try_cast(notional_amount AS DOUBLE), 0) <= 0"),
    ("invalid_currency", "currency NOT IN ('USD','GBP','EUR','NGN','JPY','CHF','CAD','AUD')"),
    ("invalid_risk_country", f"risk_country NOT IN {COUNTRY_LIST}"),
    ("invalid_instrument_type", "instrument_type NOT IN ('Equity','Bond','Fund','Private Credit','Private Equity','Derivative')"),
    ("invalid_kyc_status", "kyc_status NOT IN ('Approved','Pending','Rejected','Expired')"),
    ("invalid_counterparty_risk_rating", "counterparty_risk_rating NOT IN ('Low','Medium','High')"),
    ("high_risk_incomplete_kyc", "counterparty_risk_rating = 'High' AND kyc_status <> 'Approved'"),
    ("invalid_provider_confidence_score", f"coalesce({_SCORE} NOT BETWEEN 0 AND 1, true)"),
    ("low_provider_confidence_score", f"{_SCORE} BETWEEN 0 AND 1 AND {_SCORE} < 0.7"),
]
_FLAG_LIST = ", ".join(f"CASE WHEN {cond} THEN '{flag}' END" for flag, cond in _FLAG_SQL)
_FLAG_STEP = ("listed", f"SELECT *, list_filter([{_FLAG_LIST}], lambda x: x IS NOT NULL) AS flags FROM cleaned")
_REVIEW_STEP = ("reviewed", "SELECT * EXCLUDE (flags), array_to_string(flags, ';') AS remediation_flags, len(flags)::INTEGER AS issue_count, "
                "CASE WHEN len(list_filter(flags, lambda x: x NOT IN ('weak_counterparty_name', 'low_provider_confidence_score'))) > 0 "
                "THEN 'quarantined_for_review' ELSE 'accepted' END AS curation_status FROM listed")


def _on_reviewed(body: str, *others: str) -> str:
    return with_tables([TRADE_TABLE, *others], body, _CLEAN_STEP, _FLAG_STEP, _REVIEW_STEP)


def reviewed(spark, folder):
    return remediation.remediate(trades(spark, folder))


_CURATION_SQL = _on_reviewed("""
    SELECT total_records, records_with_issues, curated_records, total_records - curated_records AS quarantine_records,
           CAST(round_even(curated_records::DOUBLE / total_records::DOUBLE * 100.0::DOUBLE, 2) AS DOUBLE) AS curated_rate_pct,
           CAST(round_even((total_records - curated_records)::DOUBLE / total_records::DOUBLE * 100.0::DOUBLE, 2) AS DOUBLE) AS quarantine_rate_pct
    FROM (SELECT count(*) AS total_records, count(*) FILTER (issue_count > 0) AS records_with_issues,
                 count(*) FILTER (curation_status = 'accepted') AS curated_records FROM reviewed)""")


def _staged(table):
    def run(spark, folder):
        text = domain_table(spark, folder, table)
        return stage(text.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in text.columns]), TABLES[table])

    return run


def _staged_sql(table):
    fields = ", ".join(f"TRY_CAST(CAST({f.name} AS VARCHAR) AS {f.dataType.simpleString().upper().replace('STRING', 'VARCHAR')}) AS {f.name}"
                       for f in TABLES[table].fields)
    return with_tables([table], f"SELECT {fields} FROM {table}")


# Rules on the base tables, whose imperfections are their own.

def _raw_rules(spark, folder):
    from plumbline.functions.predicates import Between, Expression, FreshWithin, InSet, Matches
    from plumbline.model import Rule
    from plumbline.operators.evaluate import evaluate_pack
    from plumbline.operators.keys import ForeignKey, UniqueKey

    def rule(i, dimension, severity, check):
        return Rule(i, dimension, severity, check, "", "")

    names = ("customer", "part", "lineitem", "orders", "documents", "labels", "events")
    t = {n: base_table(spark, folder, n) for n in names}
    packs = {
        "customer": [rule("RAW-1", "Validity", "Medium", Between("c_acctbal", 0, 1_000_000)),
                     rule("RAW-2", "Validity", "Low", InSet("c_mktsegment", ("BUILDING", "MACHINERY", "HOUSEHOLD")))],
        "part": [rule("RAW-3", "Validity", "Medium", Matches("p_brand", "^Brand#[0-9]{2}$"))],
        "lineitem": [rule("RAW-4", "Uniqueness", "High", UniqueKey(("l_orderkey", "l_linenumber"))),
                     rule("RAW-5", "Referential Integrity", "High", ForeignKey("l_orderkey", "orders", "o_orderkey"))],
        "documents": [rule("RAW-6", "Uniqueness", "High", UniqueKey(("text",))),
                      rule("RAW-7", "Completeness", "Medium", ForeignKey("doc_id", "labels", "doc_id"))],
        "orders": [rule("RAW-8", "Timeliness", "Low", FreshWithin("o_orderdate", 10_000))],
        "events": [rule("RAW-9", "Accuracy", "Low", Expression("CAST(get_json_object(props, '$.k') AS INT) >= 90")),
                   rule("RAW-10", "Accuracy", "Low", Expression("value > 200"))],
    }
    return evaluate_pack(t, packs, AS_OF).select("table_name", "rule_id", "total_count", "failed_count")


_RAW_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{i}' AS rule_id, (SELECT count(*) FROM {t}) AS total_count, ({q}) AS failed_count"
    for t, i, q in (
        ("customer", "RAW-1", "SELECT count(*) FROM customer WHERE c_acctbal < 0 OR c_acctbal > 1000000"),
        ("customer", "RAW-2", "SELECT count(*) FROM customer WHERE c_mktsegment IN ('FURNITURE', 'AUTOMOBILE')"),
        ("part", "RAW-3", "SELECT count(*) FROM part WHERE NOT regexp_full_match(p_brand, 'Brand#[0-9][0-9]')"),
        ("lineitem", "RAW-4", "SELECT count(*) FROM (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1"),
        ("lineitem", "RAW-5", "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
        ("documents", "RAW-6", "SELECT count(*) FROM (SELECT count(*) OVER (PARTITION BY text) AS n FROM documents) WHERE n > 1"),
        ("documents", "RAW-7", "SELECT count(*) FROM documents ANTI JOIN labels USING (doc_id)"),
        ("orders", "RAW-8", f"SELECT count(*) FROM orders WHERE date_diff('day', CAST(o_orderdate AS DATE), {AS_OF_SQL}) > 10000"),
        ("events", "RAW-9", "SELECT count(*) FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 90"),
        ("events", "RAW-10", "SELECT count(*) FROM events WHERE value > 200"),
    )
)

_NAMES_SQL = with_tables(["entities"], r"""
    SELECT entity_id, legal_name, array_to_string(list_filter(
        string_split(regexp_replace(upper(legal_name), '[^A-Z0-9 ]', ' ', 'g'), ' '),
        lambda w: w <> '' AND w NOT IN ('LIMITED','LTD','PLC','INC','CORP','CORPORATION','LLC','HOLDINGS','GROUP')), ' ') AS comparable_name
    FROM entities""")

QUERIES = [
    *[Query(f"listing_{n}", _listing(make), with_tables(CORE_TABLES, LISTING_SQL[n]))
      for n, make in {**listings.ENTITY_LISTINGS, **listings.RULE_LISTINGS}.items()],
    Query("agg6_duplicate_groups", lambda s, d: listings.repeated_keys(trades(s, d), "trade_id", "copies"),
          with_tables([TRADE_TABLE], f"SELECT trade_id, count(*) AS copies FROM {TRADE_TABLE} GROUP BY ALL HAVING copies > 1")),
    Query("agg8_missing_count", lambda s, d: listings.missing_count(trades(s, d), "last_verified_date", "missing_count"),
          with_tables([TRADE_TABLE], f"SELECT count(*) FILTER (last_verified_date IS NULL) AS missing_count FROM {TRADE_TABLE}")),
    Query("jn2_anti_join_trades_without_issuer",
          lambda s, d: listings.without_master(trades(s, d), "issuer_id", domain_table(s, d, "issuers"), "issuer_id",
                                               ("trade_id", "issuer_id", "source_system")),
          with_tables(["issuers", TRADE_TABLE], f"SELECT trade_id, issuer_id, source_system FROM {TRADE_TABLE} ANTI JOIN issuers USING (issuer_id)")),
    *[Query(n, _view(make), with_tables(CORE_TABLES, VIEW_SQL[n])) for n, make in _VIEW_RUNS.items()],
    Query("set1_mart_quality_exceptions", lambda s, d: marts.quality_exceptions(core(s, d), AS_OF),
          with_tables(CORE_TABLES, MART_EXCEPTIONS_STEP)),
    Query("agg14_column_profile", _profile, _PROFILE_SQL),
    Query("agg14_sketched_profile", _sketched_profile, _SKETCHED_SQL),
    Query("agg15_onboarding_profile", _onboarding_profile, _ONBOARDING_SQL),
    Query("win3_top_values", _win3, _WIN3_SQL),
    Query("profile_documents",
          lambda s, d: profiling.profile(base_table(s, d, "documents"), "documents").drop("top_values"),
          "\nUNION ALL\n".join(
              f"SELECT 'documents' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS missing_count, "
              f"CAST(round_even((count(*) - count({c}))::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE, 2) AS DOUBLE) AS missing_pct, "
              f"count(DISTINCT {c}) AS unique_count, "
              f"CAST(round_even(count(DISTINCT {c})::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE, 2) AS DOUBLE) AS unique_pct, "
              f"'{t}' AS dtype FROM documents"
              for c, t in (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")))),
    Query("remediation_standardised", lambda s, d: remediation.standardise(trades(s, d)),
          with_tables([TRADE_TABLE], "SELECT * FROM cleaned", _CLEAN_STEP)),
    Query("remediation_flags", lambda s, d: remediation.flag_issues(remediation.standardised_marks(trades(s, d))).select(
              "trade_id", "batch_no", "counterparty_entity_id", "issuer_id", "remediation_flags", "issue_count"),
          _on_reviewed("SELECT trade_id, batch_no, counterparty_entity_id, issuer_id, remediation_flags, issue_count FROM reviewed")),
    Query("remediation_curated", lambda s, d: remediation.split(reviewed(s, d))[0].drop("curated_at"),
          _on_reviewed("SELECT * FROM reviewed WHERE curation_status = 'accepted'")),
    Query("remediation_quarantined", lambda s, d: remediation.split(reviewed(s, d))[1].drop("curated_at"),
          _on_reviewed("SELECT * FROM reviewed WHERE curation_status <> 'accepted'")),
    Query("agg17_top_remediation_flags", lambda s, d: remediation.flag_counts(trades(s, d)),
          _on_reviewed("SELECT flag, count(*) AS records FROM (SELECT unnest(string_split(remediation_flags, ';')) AS flag FROM reviewed "
                       "WHERE issue_count > 0) GROUP BY 1 ORDER BY records DESC, flag LIMIT 15")),
    Query("agg20_curation_summary", lambda s, d: remediation.curation_counts(trades(s, d)), _CURATION_SQL),
    Query("top6_preview_quarantine",
          lambda s, d: reports.preview(remediation.split(reviewed(s, d))[1].select(
              "trade_id", "batch_no", "issuer_id", "remediation_flags"), "trade_id"),
          _on_reviewed("SELECT trade_id, batch_no, issuer_id, remediation_flags FROM reviewed WHERE curation_status <> 'accepted' "
                       "ORDER BY trade_id, batch_no, issuer_id, remediation_flags LIMIT 100")),
    *[Query(f"src5_staged_{t}", _staged(t), _staged_sql(t)) for t in CORE_TABLES],
    Query("raw_table_rules", _raw_rules, _RAW_SQL),
    Query("comparable_entity_names",
          lambda s, d: domain_table(s, d, "entities").select("entity_id", "legal_name", normalise_name("legal_name").alias("comparable_name")),
          _NAMES_SQL),
]
