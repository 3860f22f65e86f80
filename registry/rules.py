"""Rule kinds, rule packs, exceptions and the reports built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import reports
from plumbline.operators.evaluate import (
    evaluate_pack, exceptions, failed_examples, rule_results, union_all, validate_dataset, wide_exceptions,
    with_examples, onboarding_shape, sql_shape, reconcile, core_shape,
)
from plumbline.operators.scoring import scorecard, table_summary
from plumbline.operators.sqlrules import annotated_text, read_annotated_rules, run_sql_pack, run_sql_rules, sql_failed_rows
from registry.domain import AS_OF
from plumbline.rules.core import CORE_KEYS, CORE_PACK
from plumbline.rules.trades import TRADES, trade_rules
from plumbline.rules.trades_sql import SqlRule, trade_sql_rules
from registry import conditions as c
from registry.base import TRADE_TABLE, Query, core, trades, with_tables

ALL_CORE = [r for rules in CORE_PACK.values() for r in rules]
ALL_TRADE = list(trade_rules())
ALL_SQL = list(trade_sql_rules(TRADE_TABLE, f"DATE'{AS_OF}'"))
BY_ID = {r.rule_id: r for r in ALL_CORE + ALL_TRADE + ALL_SQL}

# The rules of each kind; a kind's query evaluates all of its rules.
KINDS = {
    "prd1_not_null": ["ENT-001", "ENT-003", "ISS-001", "PRV-002"],
    "prd2_not_blank": ["TRADE_001", "CP_001", "ISSUER_001"],
    "prd3_not_sentinel": ["CP_002"],
    "prd4_in_set": ["ENT-004", "ENT-005", "ENT-006", "ISS-004", "KYC-002", "REF_001", "REF_002", "REF_003"],
    "prd5_between": ["HIER-004", "PRV-003", "PROVIDER_001"],
    "prd6_positive_number": ["AMOUNT_001"],
    "prd7_below_threshold": ["PROVIDER_002"],
    "prd8_valid_date": ["DATE_001"],
    "prd9_date_order": ["DATE_002"],
    "prd10_not_future": ["ENT-007"],
    "prd11_fresh_within": ["ENT-008", "KYC-003", "TIME_001"],
    "prd12_not_overdue": ["KYC-004"],
    "prd13_required_if": ["ENT-009", "ISS-005"],
    "prd14_implies": ["KYC_001"],
    "prd15_identifier_format": ["SECURITY_001", "ENTITY_001"],
    "prd16_not_prefix": ["ISSUER_002"],
    "prd17_not_equal": ["HIER-003"],
    "jn1_referential": ["ISS-003", "HIER-001", "HIER-002", "KYC-001"],
    "jn3_optional_reference": ["PRV-004"],
    "jn7_circular_hierarchy": ["HIER-005"],
    "agg7_duplicate_rows": ["ENT-002", "ISS-002", "PRV-001", "TRADE_002"],
}


def _kind(ids):
    def run(spark, folder):
        tables = core(spark, folder)
        packs = {**CORE_PACK, TRADE_TABLE: ALL_TRADE}
        chosen = {t: [r for r in rules if r.rule_id in ids] for t, rules in packs.items()}
        return evaluate_pack(tables, {t: rules for t, rules in chosen.items() if rules}, AS_OF).select(*c.RESULT_NAMES)

    return run


def core_results(spark, folder):
    return evaluate_pack(core(spark, folder), CORE_PACK, AS_OF)


def trade_results(spark, folder):
    return validate_dataset(trades(spark, folder), TRADES, ALL_TRADE, as_of=AS_OF)


def sql_results(spark, folder):
    return run_sql_rules(trades(spark, folder), ALL_SQL, TRADE_TABLE)


CORE_SQL = c.results_sql(ALL_CORE)
_SCHEMA_LINE = (
    f"SELECT '{TRADE_TABLE}' AS table_name, 'SCHEMA_001' AS rule_id, 'Schema' AS dimension, 'Critical' AS severity, "
    "24::BIGINT AS total_count, 0::BIGINT AS failed_count"
)
_TRADE_COUNTS = c.counts_sql(ALL_TRADE) + "\nUNION ALL\n" + _SCHEMA_LINE
TRADE_RESULT_SQL = with_tables([TRADE_TABLE], f"SELECT {c.RESULT_FIELDS} FROM counted", ("counted", _TRADE_COUNTS))
SQL_RESULT_SQL = c.results_sql(ALL_SQL)

# The scorecard and table summary as steps over ``results``.
CARD_STEP = """
    SELECT table_name, dimension, count(*) AS rule_count, CAST(sum(total_count) AS BIGINT) AS total_records_checked,
           CAST(sum(failed_count) AS BIGINT) AS total_failed_records,
           CAST(sum(CAST(pass_rate AS DECIMAL(18,4))) AS DOUBLE) / count(*)::DOUBLE AS average_pass_rate
    FROM results GROUP BY ALL"""
BAND = "CASE WHEN {0} >= 90 THEN 'Good' WHEN {0} >= 80 THEN 'Monitor' ELSE 'Needs Attention' END AS status"
SCORED_STEP = (
    "SELECT *, CAST(round_even(average_pass_rate * 100.0::DOUBLE, 2) AS DOUBLE) AS quality_score FROM card"
)
SUMMARY_STEP = """
    SELECT table_name, count(DISTINCT dimension) AS dimensions_checked, CAST(sum(rule_count) AS BIGINT) AS total_rules,
           CAST(sum(total_failed_records) AS BIGINT) AS total_failed_records,
           CAST(round_even(CAST(sum(CAST(quality_score AS DECIMAL(18,2))) AS DOUBLE) / count(*)::DOUBLE, 2) AS DOUBLE)
               AS overall_quality_score
    FROM scored GROUP BY ALL"""


def _on_core(body: str) -> str:
    """Checking SQL on top of the core results, the scorecard and the table summary."""
    return with_tables(
        c.tables_for([r.rule_id for r in ALL_CORE]), body,
        ("counted", c.counts_sql(ALL_CORE)),
        ("results", f"SELECT {c.RESULT_FIELDS} FROM counted"),
        ("card", CARD_STEP),
        ("scored", SCORED_STEP),
        ("summed", SUMMARY_STEP),
        ("summary", f"SELECT *, {BAND.format('overall_quality_score')} FROM summed"),
    )


SUMMARY_SQL = _on_core("SELECT * FROM summary")
SUMMARY_COLUMNS_SQL = _on_core("SELECT table_name, rule_id, failed_count, pass_rate FROM results")

_SHORT = "table_name, rule_id, dimension, severity, failed_count, pass_rate"
_SHORT_NAMES = [x.strip() for x in _SHORT.split(",")]


def _card(spark, folder):
    return scorecard(core_results(spark, folder))


def _summary(spark, folder):
    return table_summary(_card(spark, folder))


def _core_exceptions(name, key):
    def run(spark, folder):
        tables = core(spark, folder)
        return exceptions(tables[name], CORE_PACK[name], key, tables, AS_OF)

    return run


def _examples(spark, folder):
    df = trades(spark, folder)
    return failed_examples(df, ALL_TRADE, "trade_id", as_of=AS_OF).select("rule_id", "example_no", "record_id", "evidence")


def _results_with_examples(spark, folder):
    tables = core(spark, folder)
    shown = []
    for t, key in CORE_KEYS.items():
        results = rule_results(tables[t], CORE_PACK[t], t, tables, AS_OF)
        shown.append(with_examples(results, failed_examples(tables[t], CORE_PACK[t], key, tables, AS_OF)))
    return union_all(shown).select("table_name", "rule_id", "failed_count", "pass_rate", "failed_examples")


def _examples_sql(table, key):
    rules = list(CORE_PACK[table])
    return f"""
        SELECT r.table_name, r.rule_id, r.failed_count, r.pass_rate, '[' || coalesce(e.shown, '') || ']' AS failed_examples
        FROM ({c.results_sql(rules)}) r LEFT JOIN (
            SELECT rule_id, string_agg(evidence, ', ' ORDER BY place) AS shown FROM (
                SELECT rule_id, evidence, row_number() OVER (PARTITION BY rule_id ORDER BY record_id NULLS FIRST, evidence) AS place
                FROM ({c.exceptions_sql(rules, key)})) WHERE place <= 5 GROUP BY 1) e
        ON e.rule_id = r.rule_id"""


def _wide(spark, folder):
    return wide_exceptions(trades(spark, folder), ALL_TRADE, "trade_id", as_of=AS_OF)


_WIDE_COLUMNS = list(dict.fromkeys(x for r in ALL_TRADE for x in r.evidence))
_WIDE_SQL = with_tables([TRADE_TABLE], "\nUNION ALL BY NAME\n".join(
    f"SELECT '{r.rule_id}' AS rule_id, '{r.issue.replace(chr(39), chr(39) * 2)}' AS issue_type, '{r.severity}' AS severity, "
    f"'{r.dimension}' AS dimension, t.trade_id AS record_id, {', '.join('t.' + x for x in r.evidence)} "
    f"FROM {TRADE_TABLE} t WHERE {c.TRADES[r.rule_id]}" for r in ALL_TRADE
))


def _sql_failed(spark, folder):
    return sql_failed_rows(trades(spark, folder), ALL_SQL, TRADE_TABLE)


_SQL_COLUMNS = {
    "SQL_TRADE_002": ("trade_id", "counterparty_entity_id", "issuer_id", "source_system", "provider_name"),
    **{r.rule_id: r.columns for r in ALL_SQL if r.columns},
}
_SQL_FAILED_SQL = with_tables([TRADE_TABLE], "\nUNION ALL BY NAME\n".join(
    f"SELECT '{r.rule_id}' AS rule_id, '{r.severity}' AS severity, '{r.dimension}' AS dimension, "
    f"'{r.description.replace(chr(39), chr(39) * 2)}' AS issue_type, {', '.join('t.' + x for x in _SQL_COLUMNS[r.rule_id])} "
    f"FROM {TRADE_TABLE} t WHERE {c.TRADES_SQL[r.rule_id]}" for r in ALL_SQL
))


_SQL_ISOLATED_SQL = with_tables([TRADE_TABLE], "\nUNION ALL\n".join([
    *[f"SELECT '{r.rule_id}' AS rule_id, '{r.severity}' AS severity, t.trade_id, 'failed' AS status "
      f"FROM {TRADE_TABLE} t WHERE {c.TRADES_SQL[r.rule_id]}" for r in ALL_SQL],
    *[f"SELECT 'SQL_BREAKS_00{i}', 'Low', NULL, 'error'" for i in (1, 2, 3)],
]))

# Three rules that compile and break while running: in the condition, in the SELECT list, in a grouped SELECT.
_BREAKING = [
    SqlRule("SQL_BREAKS_001", "Low", "Schema", "Breaks in its condition.", "Repair the rule.",
            query=f"SELECT trade_id FROM {TRADE_TABLE} WHERE 1 / (length(source_system) - length(source_system)) > 0"),
    SqlRule("SQL_BREAKS_002", "Low", "Schema", "Breaks in its SELECT list.", "Repair the rule.",
            query=f"SELECT CAST(concat('x', trade_id) AS INT) AS broken FROM {TRADE_TABLE}"),
    SqlRule("SQL_BREAKS_003", "Low", "Schema", "Breaks in a group.", "Repair the rule.",
            query=f"SELECT source_system, CAST(max(concat('x', trade_id)) AS INT) AS broken FROM {TRADE_TABLE} GROUP BY source_system"),
]


def _sql_isolated(spark, folder):
    """Failing rows of the whole pack although three of its rules break while running, and a line for each of these."""
    rules = [_BREAKING[0], *ALL_SQL[:9], _BREAKING[1], *ALL_SQL[9:], _BREAKING[2]]
    results, failed = run_sql_pack(trades(spark, folder), rules, TRADE_TABLE)
    lines = results.where("status = 'error'").selectExpr("rule_id", "severity", "CAST(NULL AS STRING) AS trade_id", "status")
    return failed.selectExpr("rule_id", "severity", "trade_id", "'failed' AS status").unionByName(lines)


def _annotated(spark, folder):
    """The pack written to its annotated text form, read back and run, plus one rule that cannot run."""
    text = annotated_text(ALL_SQL, TRADE_TABLE)
    text += (
        "-- RULE_ID: SQL_BROKEN_001\n-- SEVERITY: Low\n-- DIMENSION: Schema\n-- DESCRIPTION: Names no column.\n"
        f"-- RECOMMENDATION: Repair the rule.\nSELECT no_such_column FROM {TRADE_TABLE};\n"
    )
    done = run_sql_rules(trades(spark, folder), read_annotated_rules(text), TRADE_TABLE)
    return done.select("rule_id", "severity", "dimension", "total_count", "failed_count", "failure_rate_pct", "status")


_ANNOTATED_SQL = with_tables(
    [TRADE_TABLE],
    f"SELECT rule_id, severity, dimension, total_count, failed_count, failure_rate_pct, status "
    f"FROM (SELECT {c.RESULT_FIELDS} FROM counted) "
    "UNION ALL SELECT 'SQL_BROKEN_001', 'Low', 'Schema', n, n, 100.0::DOUBLE, 'error' FROM "
    f"(SELECT count(*) AS n FROM {TRADE_TABLE})",
    ("counted", c.counts_sql(ALL_SQL)),
)

_RUN_SUMMARY = """
    SELECT count(*) AS rules_executed, count(*) FILTER (failed_count > 0) AS rules_with_failures,
           CAST(coalesce(sum(failed_count) FILTER (rule_id <> 'SCHEMA_001'), 0) AS BIGINT) AS exceptions_generated,
           count(*) FILTER (failed_count > 0 AND severity = 'Critical') AS critical_rules_failing,
           count(*) FILTER (failed_count > 0 AND severity = 'High') AS high_rules_failing,
           max(total_count) FILTER (rule_id <> 'SCHEMA_001') AS total_rows
    FROM counted"""


def _result_shapes(spark, folder):
    """The onboarding and SQL shapes brought back to one, as a display does."""
    onboarded = reconcile(onboarding_shape(trade_results(spark, folder)))
    by_sql = reconcile(sql_shape(run_sql_rules(trades(spark, folder), ALL_SQL, TRADE_TABLE)))
    checked = reconcile(core_shape(core_results(spark, folder)))
    return union_all([onboarded, by_sql, checked]).select("table_name", "rule_id", "dimension", "severity", "failed_count", "pass_rate")


_SHAPES_SQL = with_tables(
    [*c.tables_for([r.rule_id for r in ALL_CORE]), TRADE_TABLE],
    f"""SELECT table_name, rule_id, dimension, severity, failed_count, 100.0::DOUBLE - failure_rate_pct AS pass_rate
        FROM (SELECT {c.RESULT_FIELDS} FROM traded)
        UNION ALL SELECT table_name, rule_id, dimension, severity, failed_count, pass_rate
        FROM (SELECT {c.RESULT_FIELDS} FROM counted)""",
    ("traded", _TRADE_COUNTS + "\nUNION ALL\n" + c.counts_sql(ALL_SQL)),
    ("counted", c.counts_sql(ALL_CORE)),
)


def _sql_ruleset(spark, folder, ids):
    chosen = [r for r in ALL_SQL if r.rule_id in ids]
    return run_sql_rules(trades(spark, folder), chosen, TRADE_TABLE).select(*c.RESULT_NAMES)


QUERIES = [
    *[Query(name, _kind(ids), c.results_sql([BY_ID[i] for i in ids])) for name, ids in KINDS.items()],
    Query("prd14_implies_three_valued", lambda s, d: _sql_ruleset(s, d, ["SQL_KYC_001"]),
          c.results_sql([BY_ID["SQL_KYC_001"]])),
    Query("prd18_large_trade_review", lambda s, d: _sql_ruleset(s, d, ["SQL_REVIEW_001"]),
          c.results_sql([BY_ID["SQL_REVIEW_001"]])),
    Query("jn4_semi_join_duplicates", lambda s, d: _sql_ruleset(s, d, ["SQL_TRADE_002"]),
          c.results_sql([BY_ID["SQL_TRADE_002"]])),
    Query("agg1_core_rule_results", lambda s, d: core_results(s, d).select(*c.RESULT_NAMES), CORE_SQL),
    Query("agg2_trade_rule_results", lambda s, d: trade_results(s, d).select(*c.RESULT_NAMES), TRADE_RESULT_SQL),
    Query("sql_rule_results", lambda s, d: sql_results(s, d).select(*c.RESULT_NAMES), SQL_RESULT_SQL),
    Query("sql_rules_annotated_file", _annotated, _ANNOTATED_SQL),
    Query("set2_sql_failed_rows", _sql_failed, _SQL_FAILED_SQL),
    Query("set2_failed_rows_isolated", _sql_isolated, _SQL_ISOLATED_SQL),
    Query("agg3_scorecard", _card,
          _on_core(f"SELECT *, {BAND.format('quality_score')} FROM scored")),
    Query("agg4_table_summary", _summary, _on_core("SELECT * FROM summary")),
    Query("agg5_status_bands",
          lambda s, d: _card(s, d).groupBy("status").agg(F.count(F.lit(1)).alias("scores")),
          _on_core(f"SELECT status, count(*) AS scores FROM (SELECT {BAND.format('quality_score')} FROM scored) GROUP BY 1")),
    Query("agg18_kpi_snapshot", lambda s, d: reports.kpi_snapshot(_summary(s, d)),
          _on_core("SELECT count(DISTINCT table_name) AS tables_checked, CAST(sum(total_rules) AS BIGINT) AS rules_executed, "
                   "CAST(round_even(CAST(sum(CAST(overall_quality_score AS DECIMAL(18,2))) AS DOUBLE) / count(*)::DOUBLE, 2) AS DOUBLE) "
                   "AS average_quality_score, CAST(sum(total_failed_records) AS BIGINT) AS failed_record_checks FROM summary")),
    Query("agg19_trade_run_summary", lambda s, d: reports.run_summary(trade_results(s, d)),
          with_tables([TRADE_TABLE], _RUN_SUMMARY, ("counted", _TRADE_COUNTS))),
    Query("agg19_sql_run_summary", lambda s, d: reports.run_summary(sql_results(s, d)),
          with_tables([TRADE_TABLE], _RUN_SUMMARY, ("counted", c.counts_sql(ALL_SQL)))),
    Query("top1_lowest_tables", lambda s, d: reports.lowest_tables(_summary(s, d)),
          _on_core("SELECT * FROM summary ORDER BY overall_quality_score, table_name LIMIT 5")),
    Query("top2_most_failed_core", lambda s, d: reports.most_failed(core_results(s, d)).select(*_SHORT_NAMES),
          _on_core(f"SELECT {_SHORT} FROM results ORDER BY failed_count DESC, rule_id LIMIT 10")),
    Query("top2_most_failed_trades",
          lambda s, d: reports.most_failed(trade_results(s, d)).select("rule_id", "severity", "failed_count", "failure_rate_pct"),
          with_tables([TRADE_TABLE], f"SELECT rule_id, severity, failed_count, failure_rate_pct FROM (SELECT {c.RESULT_FIELDS} "
                      "FROM counted) ORDER BY failed_count DESC, rule_id LIMIT 10", ("counted", _TRADE_COUNTS))),
    Query("top2_most_failed_sql",
          lambda s, d: reports.most_failed(sql_results(s, d)).select("rule_id", "severity", "dimension", "failed_count", "failure_rate_pct"),
          with_tables([TRADE_TABLE], f"SELECT rule_id, severity, dimension, failed_count, failure_rate_pct FROM (SELECT "
                      f"{c.RESULT_FIELDS} FROM counted) ORDER BY failed_count DESC, rule_id LIMIT 10",
                      ("counted", c.counts_sql(ALL_SQL)))),
    Query("top3_failed_rules_by_severity",
          lambda s, d: reports.failed_rules(core_results(s, d), "HIGH", 50).select(*_SHORT_NAMES),
          _on_core(f"SELECT {_SHORT} FROM results WHERE failed_count > 0 AND severity ILIKE 'high'")),
    Query("top5_critical_failures", lambda s, d: reports.critical_failures(core_results(s, d)).select(*_SHORT_NAMES),
          _on_core(f"SELECT {_SHORT} FROM results WHERE failed_count > 0 AND severity = 'Critical'")),
    Query("prd20_selected_rules",
          lambda s, d: reports.select_rules(core_results(s, d), ["Critical", "Medium"], ["Validity", "Uniqueness"]).select(*_SHORT_NAMES),
          _on_core(f"SELECT {_SHORT} FROM results WHERE failed_count > 0 AND severity IN ('Critical', 'Medium') "
                   "AND dimension IN ('Validity', 'Uniqueness')")),
    Query("result_shapes_reconciled", _result_shapes, _SHAPES_SQL),
    Query("trade_exceptions",
          lambda s, d: exceptions(trades(s, d), ALL_TRADE, "trade_id", as_of=AS_OF),
          c.exceptions_sql(ALL_TRADE, "trade_id")),
    Query("set2_trade_exceptions_wide", _wide, _WIDE_SQL),
    *[Query(f"exceptions_{name}", _core_exceptions(name, key), c.exceptions_sql(list(CORE_PACK[name]), key))
      for name, key in CORE_KEYS.items()],
    Query("win1_failed_examples", _examples,
          f"SELECT rule_id, example_no, record_id, evidence FROM (SELECT *, row_number() OVER (PARTITION BY rule_id "
          f"ORDER BY record_id NULLS FIRST, evidence)::INTEGER AS example_no FROM ({c.exceptions_sql(ALL_TRADE, 'trade_id')})) "
          "WHERE example_no <= 5"),
    Query("agg1_results_with_examples", _results_with_examples,
          "\nUNION ALL\n".join(_examples_sql(t, key) for t, key in CORE_KEYS.items())),
]
