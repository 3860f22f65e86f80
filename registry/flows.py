"""Sources and sinks read back, the provider feed, anomalies, serving queries and the batch jobs."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from plumbline.operators import anomaly, marts, profiling, remediation, reports
from plumbline.operators.evaluate import exceptions, union_all, validate_dataset
from plumbline.plans import jobs
from plumbline.rules.registered import spec_rules
from plumbline.rules.trades import TRADES
from registry.domain import AS_OF, base_table, domain_table, domain_tables
from plumbline.schemas import EVENT, PROVIDER_FEED, TABLES
from plumbline.session import fresh_path
from plumbline.sources.sinks import read_mart, write_curated, write_mart, write_report
from plumbline.sources.tables import load_registry, read_csv, read_dataset, read_folder, read_tolerant, stage_views
from plumbline.streaming import feed
from registry.base import AS_OF_SQL, TRADE_TABLE, Query, core, trades, with_tables
from registry import rules, tables
from registry.rules import ALL_CORE, ALL_SQL, ALL_TRADE, SUMMARY_COLUMNS_SQL, SUMMARY_SQL, core_results
from registry.conditions import COUNTRY_LIST, TRADES as TRADE_CONDITIONS, counts_sql, exceptions_sql
from registry.tables import MART_EXCEPTIONS_STEP, VIEW_SQL, _on_reviewed

RUN = "run-0001"

# Sources and sinks: data derived from the given tables is written, then read back by the source.


def _csv_copy(spark, folder, table):
    path = fresh_path(spark, f"csv-{table}")
    domain_table(spark, folder, table).write.option("header", True).option("emptyValue", '""').csv(path)
    return path


def _csv_scan(spark, folder):
    return read_csv(spark, _csv_copy(spark, folder, "entities"), TABLES["entities"]).select(
        "entity_id", "legal_name", "country_code", "entity_type", "status", "last_verified_date")


_CSV_SQL = with_tables(["entities"], """
    SELECT entity_id, legal_name, CASE WHEN country_code NOT IN ('N/A', '') THEN country_code END AS country_code,
           entity_type, status, CAST(last_verified_date AS VARCHAR) AS last_verified_date FROM entities""")


def _csv_line_breaks(spark, folder):
    """Whole texts, with the line breaks and quotes put into them, through CSV files and back."""
    path = fresh_path(spark, "csv-documents")
    base_table(spark, folder, "documents").selectExpr("doc_id", "lang", f"{_BROKEN_TEXT} AS text").write.option("header", True).option(
        "escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_csv(spark, path).selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "lang", "sha2(text, 256) AS text_sha256")


# A line break for every blank, with quotes and separators at the breaks.
_BROKEN_TEXT = "concat('\"', replace(text, ' ', '\",\"\n'), '\n,x')"
_LINE_BREAKS_SQL = """SELECT doc_id, lang, sha256('"' || replace(text, ' ', '","' || chr(10)) || chr(10) || ',x') AS text_sha256 FROM documents"""


def _folder_scan(spark, folder):
    """A folder of CSV tables profiled table by table."""
    root = fresh_path(spark, "raw")
    for t in ("issuers", "kyc_attributes"):
        domain_table(spark, folder, t).write.option("header", True).csv(f"{root}/{t}.csv")
    frames = [profiling.profile(df, t).drop("top_values") for t, df in read_folder(spark, root).items()]
    return frames[0].unionByName(frames[1]).select("table_name", "column_name", "row_count", "missing_count", "unique_count")


_FOLDER_SQL = with_tables(["issuers", "kyc_attributes"], "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, count(*) AS row_count, count(*) - count({f.name}) AS missing_count, "
    f"count(DISTINCT {f.name}) AS unique_count FROM {t}" for t in ("issuers", "kyc_attributes") for f in TABLES[t].fields))


def _tolerant_scan(spark, folder):
    """A typed scan: rows whose score is no number are dropped."""
    path = fresh_path(spark, "csv-scores")
    trades(spark, folder).selectExpr("issuer_id", "coalesce(provider_confidence_score, 'none') AS score").write.option(
        "header", True).csv(path)
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("issuer_id", T.StringType()), T.StructField("score", T.DoubleType())])
    read_tolerant(spark, path, schema, "scored_issuers")
    return spark.sql("SELECT issuer_id, count(*) AS rows, CAST(sum(CAST(score AS DECIMAL(18,2))) AS DOUBLE) AS total "
                     "FROM scored_issuers WHERE score IS NOT NULL GROUP BY issuer_id")


_TOLERANT_SQL = with_tables([TRADE_TABLE], f"""
    SELECT nullif(issuer_id, '') AS issuer_id, count(*) AS rows,
           CAST(sum(CAST(try_cast(provider_confidence_score AS DOUBLE) AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM {TRADE_TABLE} WHERE try_cast(provider_confidence_score AS DOUBLE) IS NOT NULL GROUP BY 1""")


def _report_files(spark, folder):
    path = write_report(reports.most_failed(core_results(spark, folder), 27), fresh_path(spark, "report"), "csv", one_file=True)
    return spark.read.option("header", True).csv(path).selectExpr(
        "table_name", "rule_id", "CAST(failed_count AS BIGINT) AS failed_count", "CAST(pass_rate AS DOUBLE) AS pass_rate")


def _failing_rows_files(spark, folder):
    """The failing rows of the trade pack as CSV files, one per task, and back; CSV readers take an empty value for a missing one."""
    failed = exceptions(trades(spark, folder), ALL_TRADE, "trade_id", as_of=AS_OF)
    path = write_report(failed, fresh_path(spark, "failing-rows"), "csv")
    return read_csv(spark, path, na_tokens=()).groupBy("rule_id", "record_id").count().groupBy("rule_id").agg(
        F.expr("sum(count) AS failing_rows"), F.expr("count(record_id) AS records"))


def _curated_folders(spark, folder):
    path = write_curated(remediation.remediate(trades(spark, folder)), fresh_path(spark, "curated"))
    return reports.curation_summary(spark.read.parquet(path))


def _mart_table(spark, folder):
    table = "mart_entity_quality_summary"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    write_mart(marts.entity_quality_summary(domain_table(spark, folder, "entities"), AS_OF), table, fresh_path(spark, table))
    return read_mart(spark, table)


def _staging_views(spark, folder):
    t = core(spark, folder)
    stage_views({n: t[n] for n in ("entities", "kyc_attributes")})
    return spark.sql("SELECT source_system, count(*) AS entities, count(last_verified_date) AS verified FROM stg_entities GROUP BY 1")


def _stakeholder_views(spark, folder):
    t = core(spark, folder)
    marts.register_views({n: t[n] for n in TABLES if n != TRADE_TABLE}, AS_OF)
    return spark.sql("SELECT v.source_system, v.total_records, v.invalid_country_count, h.self_reference_count "
                     "FROM vw_entity_quality_by_source v LEFT JOIN vw_hierarchy_exception_summary h USING (source_system)")


# The provider feed

def _validated_stream(spark, folder, limit):
    messages, manifest = feed.feed_run(domain_table(spark, folder, "provider_feed"), RUN, limit)
    output = fresh_path(spark, "validated")
    feed.run_validation(feed.stream_files(spark, messages), RUN, output, require=True)
    return spark.read.parquet(output), manifest


def _validated_archive(spark, folder):
    messages, _ = feed.feed_run(domain_table(spark, folder, "provider_feed"), RUN, None)
    output, archive = fresh_path(spark, "validated"), fresh_path(spark, "archive")
    feed.run_validation(feed.stream_files(spark, messages), RUN, output, archive)
    return archive


def _summary_stream(spark, folder):
    """The summary by a stateful stream of several triggers, stopped and continued in the middle."""
    messages, _ = feed.feed_run(domain_table(spark, folder, "provider_feed"), RUN, None)
    output = fresh_path(spark, "summary")
    feed.run_summary_stream(feed.stream_files(spark, messages, 2), RUN, output)
    more, _ = feed.feed_run(domain_table(spark, folder, "provider_feed"), RUN, 100)
    feed.publish_files(spark.read.text(more), messages)
    return feed.run_summary_stream(feed.stream_files(spark, messages, 2), RUN, output)


_EVENT_STEP = ("checked", f"""
    SELECT *, list_filter([CASE WHEN coalesce(trim(legal_name), '') = '' THEN 'Missing legal name' END,
        CASE WHEN coalesce(country_code, '?') NOT IN {COUNTRY_LIST} THEN 'Invalid country code' END,
        CASE WHEN coalesce(confidence_score NOT BETWEEN 0 AND 1, true) THEN 'Invalid confidence score' END], lambda x: x IS NOT NULL) AS found
    FROM provider_feed""")
_EVENT_FIELDS = ("provider_record_id, provider_name, legal_name, country_code, "
                 "CASE WHEN len(found) > 0 THEN 'failed' ELSE 'passed' END AS status, len(found)::INTEGER AS issue_count, "
                 "array_to_string(found, '; ') AS issues")
_EVENT_NAMES = ["provider_record_id", "provider_name", "legal_name", "country_code", "status", "issue_count", "issues"]


def _on_events(body):
    return with_tables(["provider_feed"], body, _EVENT_STEP, ("validated", f"SELECT {_EVENT_FIELDS} FROM checked"))


def _events(spark, folder):
    numbered = feed.first_records(domain_table(spark, folder, "provider_feed"), 100)
    return feed.build_events(numbered, RUN).selectExpr(
        "event_id", "run_id", "event_type", "sequence_number", "key", "payload.legal_name AS legal_name",
        "payload.country_code AS country_code", "payload.feed_date AS feed_date")


_ORDERED = ", ".join(f"{f.name} NULLS FIRST" for f in PROVIDER_FEED.fields)
_FIRST_EVENTS = with_tables(["provider_feed"], f"""
    SELECT sha256('{RUN}:' || CAST(n AS VARCHAR)) AS event_id, '{RUN}' AS run_id, 'provider_record_received' AS event_type,
           n AS sequence_number, provider_record_id AS key, legal_name, country_code, CAST(feed_date AS VARCHAR) AS feed_date
    FROM (SELECT *, row_number() OVER (ORDER BY {_ORDERED}) AS n FROM provider_feed) WHERE n <= 100""")


def _messages(spark, folder):
    """The message keys and payload texts of the whole feed."""
    source = domain_table(spark, folder, "provider_feed")
    numbered = feed.number_rows(source.select(*[f.name for f in PROVIDER_FEED.fields]), fresh_path(spark, "numbered"))
    return feed.encode(feed.build_events(numbered, RUN)).selectExpr(
        "key", "get_json_object(value, '$.run_id') AS run_id", "get_json_object(value, '$.payload.legal_name') AS legal_name",
        "get_json_object(value, '$.payload.sector') AS sector")


def _numbering(spark, folder):
    """Facts that hold for a numbering without gaps."""
    source = trades(spark, folder).select("trade_id", "batch_no")
    numbered = feed.number_rows(source, fresh_path(spark, "numbered"))
    return numbered.selectExpr("min(sequence_number) AS first", "max(sequence_number) AS last", "count(DISTINCT sequence_number) AS distinct_numbers")


# Anomalies

def _features(spark, folder):
    return anomaly.entity_features(domain_table(spark, folder, "entities"), AS_OF)


_FEATURE_FIELDS = f"""
    entity_id, length(coalesce(legal_name, ''))::INTEGER AS legal_name_length,
    CASE WHEN registration_number IS NULL THEN 0 ELSE 1 END AS has_registration_number,
    date_diff('day', last_verified_date, {AS_OF_SQL})::INTEGER AS days_since_verified,
    (legal_name IS NULL)::INTEGER + (country_code IS NULL)::INTEGER + (registration_number IS NULL)::INTEGER
        + (entity_type IS NULL)::INTEGER + (sector IS NULL)::INTEGER + (status IS NULL)::INTEGER
        + (last_verified_date IS NULL)::INTEGER AS missing_field_count,
    coalesce(country_code, 'MISSING') AS country_code, coalesce(entity_type, 'MISSING') AS entity_type,
    coalesce(status, 'MISSING') AS status, coalesce(source_system, 'MISSING') AS source_system"""
_FEATURE_STEP = ("features", f"SELECT {_FEATURE_FIELDS} FROM entities")


def scored(spark, folder):
    return anomaly.score_entities(domain_table(spark, folder, "entities"), AS_OF)


# A registry file

def _registry_rules(spark, folder):
    """Two data sets registered in a JSON file, read as CSV files and checked by the rules that the file implies."""
    root = fresh_path(spark, "registered")
    for t in (TRADE_TABLE, "entities"):
        domain_table(spark, folder, t).write.option("header", True).option("escape", '"').option("compression", "gzip").csv(f"{root}/incoming/{t}.csv")
    spark.createDataFrame([(json.dumps(_REGISTRY),)], "value string").coalesce(1).write.text(f"{root}/registry.json")
    frames = []
    for dataset, spec in load_registry(spark, f"{root}/registry.json").items():
        df = read_dataset(spark, spec, root)
        frames.append(validate_dataset(df, spec, spec_rules(spec, df.columns)))
    return union_all(frames).select("table_name", "rule_id", "dimension", "severity", "total_count", "failed_count", "status")


_ENTITY_TYPES = ("Public Company", "Private Company", "Fund", "SPV", "Government Entity", "Financial Institution")
_REGISTRY = {"datasets": {
    TRADE_TABLE: {
        "description": "Trades.", "file_path": f"incoming/{TRADE_TABLE}.csv", "primary_key": "trade_id",
        "required_columns": ["trade_id", "trade_date", "currency", "instrument_type"], "date_columns": ["trade_date"],
        "allowed_values": {"currency": list(TRADES.allowed_values["currency"]), "instrument_type": list(TRADES.allowed_values["instrument_type"]),
                           "country_code": ["US", "GB"]}},
    "entities": {"file_path": "incoming/entities.csv", "primary_key": "entity_id", "required_columns": ["entity_id", "entity_type"],
                 "allowed_values": {"entity_type": list(_ENTITY_TYPES)}},
}}


def _registered_sql(table, required, checks):
    lines = [f"SELECT '{table}' AS table_name, 'SCHEMA_001' AS rule_id, 'Schema' AS dimension, 'Critical' AS severity, "
             f"{required}::BIGINT AS total_count, 0::BIGINT AS failed_count"]
    lines += [f"SELECT '{table}', '{i}', '{d}', '{s}', count(*), count(*) FILTER ({w}) FROM {table} t" for i, d, s, w in checks]
    return "\nUNION ALL\n".join(lines)


_REGISTRY_SQL = with_tables([TRADE_TABLE, "entities"], "SELECT *, CASE WHEN failed_count > 0 THEN 'failed' ELSE 'passed' END AS status FROM (" + "\nUNION ALL\n".join([
    _registered_sql(TRADE_TABLE, 4, [
        ("KEY_001", "Completeness", "Critical", TRADE_CONDITIONS["TRADE_001"]), ("KEY_002", "Uniqueness", "Critical", TRADE_CONDITIONS["TRADE_002"]),
        ("DATE_trade_date", "Validity", "High", TRADE_CONDITIONS["DATE_001"]), ("SET_currency", "Validity", "High", TRADE_CONDITIONS["REF_001"]),
        ("SET_instrument_type", "Validity", "High", TRADE_CONDITIONS["REF_003"])]),
    _registered_sql("entities", 2, [
        ("KEY_001", "Completeness", "Critical", "coalesce(trim(entity_id), '') = ''"),
        ("KEY_002", "Uniqueness", "Critical", "entity_id IN (SELECT entity_id FROM entities GROUP BY 1 HAVING count(*) > 1)"),
        ("SET_entity_type", "Validity", "High", f"coalesce(entity_type, '?') NOT IN {_ENTITY_TYPES}")]),
]) + ")")


# The batch jobs

def _core_job(spark, folder):
    out = jobs.core_job(core(spark, folder), fresh_path(spark, "core-job"), AS_OF)
    return out["table_quality_summary"]


# Every report of the core run: the query whose SQL gives it, and the columns that are compared.
_RULE = "table_name rule_id dimension severity failed_count pass_rate"
_CORE_REPORTS = {
    "profile_summary": ("agg14_column_profile", "table_name column_name row_count missing_count missing_pct unique_count unique_pct dtype"),
    "rule_results": ("agg1_results_with_examples", "table_name rule_id failed_count pass_rate failed_examples"),
    "quality_scorecard": ("agg3_scorecard", "table_name dimension rule_count total_records_checked total_failed_records quality_score status"),
    "table_quality_summary": ("agg4_table_summary", "table_name dimensions_checked total_rules total_failed_records overall_quality_score status"),
    "kpi_snapshot": ("agg18_kpi_snapshot", "tables_checked rules_executed average_quality_score failed_record_checks"),
    "lowest_tables": ("top1_lowest_tables", "table_name total_rules overall_quality_score status"),
    "most_failed_rules": ("top2_most_failed_core", _RULE),
    "critical_failures": ("top5_critical_failures", _RULE),
    "mart_entity_quality_summary": ("mart_entity_quality_summary", "source_system total_records missing_legal_name_count "
                                    "missing_registration_number_count invalid_country_count stale_active_record_count"),
    "mart_quality_exceptions": ("set1_mart_quality_exceptions", "table_name record_id issue_type severity source_system"),
}
_DECIMAL = ("missing_pct", "unique_pct", "pass_rate", "quality_score", "overall_quality_score", "average_quality_score")


def _line(columns):
    texts = (f"CAST(CAST({x} AS DECIMAL(18, 4)) AS STRING)" if x in _DECIMAL else f"CAST({x} AS STRING)" for x in columns.split())
    return f"concat_ws('|', {', '.join(f'coalesce({x}, {chr(39)}~{chr(39)})' for x in texts)})"


def _core_reports(spark, folder):
    """All eleven reports of the core run, line by line; of the anomalies, which SQL can't give, whether they are few enough."""
    out = jobs.core_job(core(spark, folder), fresh_path(spark, "core-job"), AS_OF)
    lines = [out[o].selectExpr(f"'{o}' AS report", f"{_line(columns)} AS line") for o, (_, columns) in _CORE_REPORTS.items()]
    rows = core(spark, folder)["entities"].selectExpr("count(*) AS n")
    few = out["entity_anomalies"].agg(F.expr("count(*) AS found")).join(rows).selectExpr(
        "'entity_anomalies' AS report", "CAST(found BETWEEN 1 AND floor((n - 1) * 0.03) + 1 AS STRING) AS line")
    return union_all([*lines, few])


_SQL_OF = {q.name: q.sql for q in (*rules.QUERIES, *tables.QUERIES)}
_CORE_REPORTS_SQL = "\nUNION ALL\n".join([
    *[f"SELECT '{o}' AS report, {_line(columns)} AS line FROM ({_SQL_OF[query]})" for o, (query, columns) in _CORE_REPORTS.items()],
    "SELECT 'entity_anomalies', 'true'"])


def _full_job(spark, folder):
    """The number of rows in the outputs of every stage."""
    out = jobs.full_job(domain_tables(spark, folder), fresh_path(spark, "full-job"), AS_OF)
    names = (("core", "rule_results"), ("core", "mart_quality_exceptions"), ("onboarding", "column_profile"), ("onboarding", "rule_results"),
             ("onboarding", "failed_records"), ("sql", "rule_results"), ("sql", "failed_records"),
             ("remediation", "curated"), ("remediation", "quarantined"))
    frames = [out[s][o].selectExpr("count(*) AS rows").selectExpr(f"'{s}' AS stage", f"'{o}' AS output", "rows") for s, o in names]
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    return whole


_FULL_JOB_SQL = _on_reviewed(f"""
    SELECT 'core' AS stage, 'rule_results' AS output, {len(ALL_CORE)}::BIGINT AS rows
    UNION ALL SELECT 'core', 'mart_quality_exceptions', (SELECT count(*) FROM ({MART_EXCEPTIONS_STEP}))
    UNION ALL SELECT 'onboarding', 'column_profile', 25
    UNION ALL SELECT 'onboarding', 'rule_results', {len(ALL_TRADE) + 1}
    UNION ALL SELECT 'onboarding', 'failed_records', (SELECT CAST(sum(failed_count) AS BIGINT) FROM ({counts_sql(ALL_TRADE)}))
    UNION ALL SELECT 'sql', 'rule_results', {len(ALL_SQL)}
    UNION ALL SELECT 'sql', 'failed_records', (SELECT CAST(sum(failed_count) AS BIGINT) FROM ({counts_sql(ALL_SQL)}))
    UNION ALL SELECT 'remediation', 'curated', (SELECT count(*) FROM reviewed WHERE curation_status = 'accepted')
    UNION ALL SELECT 'remediation', 'quarantined', (SELECT count(*) FROM reviewed WHERE curation_status <> 'accepted')""",
    "entities", "issuers", "kyc_attributes")

QUERIES = [
    Query("src1_csv_scan", _csv_scan, _CSV_SQL),
    Query("src1_csv_line_breaks", _csv_line_breaks, _LINE_BREAKS_SQL),
    Query("src2_folder_scan", _folder_scan, _FOLDER_SQL),
    Query("src3_registry_rules", _registry_rules, _REGISTRY_SQL),
    Query("src4_tolerant_scan", _tolerant_scan, _TOLERANT_SQL),
    Query("src10_mart_table", _mart_table, with_tables(["entities"], VIEW_SQL["mart_entity_quality_summary"])),
    Query("snk1_report_files", _report_files, SUMMARY_COLUMNS_SQL),
    Query("snk1_failing_rows_files", _failing_rows_files, (
        "SELECT rule_id, count(*) AS failing_rows, count(DISTINCT nullif(record_id, '')) AS records "
        f"FROM ({exceptions_sql(ALL_TRADE, 'trade_id')}) GROUP BY 1")),
    Query("snk2_curated_folders", _curated_folders, _on_reviewed("""
        SELECT count(*) AS total_records, count(*) FILTER (issue_count > 0) AS records_with_issues,
               count(*) FILTER (curation_status = 'accepted') AS curated_records,
               count(*) FILTER (curation_status <> 'accepted') AS quarantine_records,
               CAST(round_even((count(*) FILTER (curation_status = 'accepted'))::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE, 2) AS DOUBLE) AS curated_rate_pct,
               CAST(round_even((count(*) FILTER (curation_status <> 'accepted'))::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE, 2) AS DOUBLE) AS quarantine_rate_pct
        FROM reviewed""")),
    Query("snk6_staging_views", _staging_views, with_tables(["entities"],
          "SELECT source_system, count(*) AS entities, count(last_verified_date) AS verified FROM entities GROUP BY 1")),
    Query("stakeholder_views", _stakeholder_views, with_tables(["entities", "entity_hierarchy"], f"""
        SELECT e.source_system, e.total_records, e.invalid_country_count, h.self_reference_count FROM (
            SELECT source_system, count(*) AS total_records,
                   count(*) FILTER (coalesce(country_code, '?') NOT IN {COUNTRY_LIST}) AS invalid_country_count
            FROM entities GROUP BY 1) e LEFT JOIN (
            SELECT source_system, count(*) FILTER (child_entity_id = parent_entity_id) AS self_reference_count
            FROM entity_hierarchy GROUP BY 1) h ON h.source_system = e.source_system""")),
    Query("feed_events_built", _events, _FIRST_EVENTS),
    Query("snk4_feed_messages", _messages, with_tables(["provider_feed"],
          f"SELECT provider_record_id AS key, '{RUN}' AS run_id, legal_name, sector FROM provider_feed")),
    Query("feed_gapless_numbering", _numbering, with_tables([TRADE_TABLE],
          f"SELECT 1::BIGINT AS first, count(*) AS last, count(*) AS distinct_numbers FROM {TRADE_TABLE}")),
    Query("src7_feed_validated_stream", lambda s, d: _validated_stream(s, d, None)[0].select(*_EVENT_NAMES),
          _on_events("SELECT * FROM validated")),
    Query("feed_failed_events", lambda s, d: feed.failed_events(_validated_stream(s, d, None)[0]).select(*_EVENT_NAMES),
          _on_events("SELECT * FROM validated WHERE status = 'failed'")),
    Query("agg16_feed_summary", lambda s, d: feed.feed_summary(_validated_stream(s, d, None)[0]),
          _on_events("SELECT provider_name, status, count(*) AS event_count, CAST(sum(issue_count) AS BIGINT) AS total_issues "
                     "FROM validated GROUP BY ALL")),
    Query("agg16_feed_summary_stream", _summary_stream,
          with_tables(["provider_feed"], f"""
              SELECT provider_name, status, count(*) AS event_count, CAST(sum(issue_count) AS BIGINT) AS total_issues FROM (
                  SELECT provider_name, status, issue_count FROM validated
                  UNION ALL SELECT provider_name, status, issue_count FROM (
                      SELECT {_EVENT_FIELDS}, row_number() OVER (ORDER BY {_ORDERED}) AS n FROM checked) WHERE n <= 100) GROUP BY ALL""",
              _EVENT_STEP, ("validated", f"SELECT {_EVENT_FIELDS} FROM checked"))),
    Query("snk3_feed_archive", lambda s, d: s.read.schema(EVENT).json(_validated_archive(s, d)).selectExpr(
              "run_id", "key", "payload.legal_name AS legal_name", "payload.provider_name AS provider_name"),
          with_tables(["provider_feed"], f"SELECT '{RUN}' AS run_id, provider_record_id AS key, legal_name, provider_name FROM provider_feed")),
    Query("src9_feed_preview", lambda s, d: feed.preview_events(s, _preview_archive(s, d)).selectExpr("sequence_number", "key", "payload.legal_name AS legal_name"),
          with_tables(["provider_feed"], f"SELECT n AS sequence_number, provider_record_id AS key, legal_name FROM (SELECT *, row_number() OVER "
                      f"(ORDER BY {_ORDERED}) AS n FROM provider_feed) WHERE n <= 100")),
    Query("snk5_feed_completeness", lambda s, d: _completeness(s, d),
          with_tables(["provider_feed"], f"SELECT '{RUN}' AS run_id, count(*) AS published_count, count(*) AS consumed_count, true AS complete FROM provider_feed")),
    Query("anomaly_features", _features, with_tables(["entities"], "SELECT * FROM features", _FEATURE_STEP)),
    Query("anomaly_imputed", lambda s, d: anomaly.impute(_features(s, d)),
          with_tables(["entities"], "SELECT * REPLACE (coalesce(days_since_verified::DOUBLE, (SELECT quantile_cont(days_since_verified, 0.5) FROM features)) "
                      "AS days_since_verified) FROM features", _FEATURE_STEP)),
    Query("anomaly_one_hot", lambda s, d: anomaly.one_hot(_features(s, d)),
          with_tables(["entities"], "\nUNION ALL\n".join(f"SELECT entity_id, '{c}' AS feature, {c} AS category FROM features" for c in anomaly.CATEGORICAL), _FEATURE_STEP)),
    Query("anomaly_one_hot_totals", lambda s, d: anomaly.one_hot_totals(_features(s, d)),
          with_tables(["entities"], "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, {c} AS category, count(*) AS rows FROM features GROUP BY ALL"
                                                         for c in anomaly.CATEGORICAL), _FEATURE_STEP)),
    Query("anomaly_scores", lambda s, d: scored(s, d).select("entity_id", "anomaly_label", "anomaly_score")),
    Query("top4_anomalies", lambda s, d: reports.top_anomalies(anomaly.anomalies(scored(s, d)), 50).select(
        "entity_id", "legal_name", "country_code", "entity_type", "status", "source_system", "anomaly_score")),
    Query("agg17_anomalies_by_source", lambda s, d: reports.anomalies_by_source(anomaly.anomalies(scored(s, d)))),
    Query("core_job", _core_job, SUMMARY_SQL),
    Query("core_job_reports", _core_reports, _CORE_REPORTS_SQL),
    Query("full_job", _full_job, _FULL_JOB_SQL),
]


def _preview_archive(spark, folder):
    """The archive of the whole feed, numbered in key order."""
    source = domain_table(spark, folder, "provider_feed")
    columns = [f.name for f in PROVIDER_FEED.fields]
    numbered = feed.number_rows(source.select(*columns).orderBy(*columns), fresh_path(spark, "numbered"))
    messages = feed.publish_files(feed.encode(feed.build_events(numbered, RUN)), fresh_path(spark, "messages"))
    output, archive = fresh_path(spark, "validated"), fresh_path(spark, "archive")
    feed.run_validation(feed.stream_files(spark, messages), RUN, output, archive)
    return archive


def _completeness(spark, folder):
    validated, manifest = _validated_stream(spark, folder, None)
    return feed.completeness(validated, feed.read_manifest(spark, manifest))
