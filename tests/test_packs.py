"""Rule packs, exceptions, SQL rules and remediation on hand-made trades, with their invariants."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators import remediation
from plumbline.operators.evaluate import (
    evaluate_pack, exceptions, failed_examples, onboarding_shape, reconcile, rule_results, sql_shape, validate_dataset,
    wide_exceptions, with_examples,
)
from plumbline.operators.marts import issuer_linkage
from plumbline.operators.reports import curation_summary, failed_rules, run_summary
from plumbline.operators.sqlrules import annotated_text, lifted, read_annotated_rules, run_sql_pack, run_sql_rules, sql_failed_rows
from plumbline.rules.core import CORE_PACK
from plumbline.rules.trades import TRADE_COLUMNS, TRADES, trade_rules
from plumbline.rules.trades_sql import SqlRule, trade_sql_rules
from plumbline.schemas import TABLES, TRADE_LINKS

AS_OF = "2025-06-30"
GOOD = dict(
    trade_id="T1", counterparty_entity_id="E1", counterparty_name="Alpha Ltd", issuer_id="ISS1", issuer_name="Alpha",
    instrument_type="Bond", instrument_id="I1", isin="US0378331005", trade_date="2025-01-02",
    settlement_date="2025-01-04", notional_amount="1000.50", currency="USD", risk_country="US", booking_country="US",
    exchange_mic="XNYS", kyc_status="Approved", counterparty_risk_rating="Low", lei="A" * 20, sector="Energy",
    source_system="S", provider_name="P", provider_confidence_score="0.9", ingestion_timestamp="2025-01-05T00:00:00Z",
    last_verified_date="2025-01-01",
)

# What to change in a good trade, the rules that then fire, the SQL rules, and the remediation flags.
VARIANTS = [
    ({}, [], [], ""),
    ({"trade_id": " "}, ["TRADE_001"], ["SQL_TRADE_001"], "missing_trade_id"),
    ({"counterparty_entity_id": None}, ["CP_001"], ["SQL_CP_001"], "missing_counterparty_entity_id"),
    ({"counterparty_name": "Unknown Counterparty"}, ["CP_002"], ["SQL_CP_002"], "weak_counterparty_name"),
    ({"issuer_id": ""}, ["ISSUER_001"], ["SQL_ISSUER_001"], "invalid_or_orphan_issuer_id"),
    ({"issuer_id": "ISS-ORPHAN-9"}, ["ISSUER_002"], ["SQL_ISSUER_001"], "invalid_or_orphan_issuer_id"),
    ({"trade_date": "soon"}, ["DATE_001"], ["SQL_DATE_001"], "invalid_trade_date"),
    ({"settlement_date": "2025-01-01"}, ["DATE_002"], ["SQL_DATE_002"], "settlement_before_trade_date"),
    ({"settlement_date": None}, [], [], "invalid_settlement_date"),
    ({"notional_amount": "0"}, ["AMOUNT_001"], ["SQL_AMOUNT_001"], "invalid_notional_amount"),
    ({"currency": "EURO"}, ["REF_001"], ["SQL_REF_001"], ""),
    ({"currency": " USD"}, [], ["SQL_REF_001"], ""),
    ({"currency": "XXX"}, ["REF_001"], ["SQL_REF_001"], "invalid_currency"),
    ({"risk_country": "UK"}, ["REF_002"], ["SQL_REF_002"], ""),
    ({"instrument_type": "Equityy"}, ["REF_003"], ["SQL_REF_003"], ""),
    ({"counterparty_risk_rating": "High", "kyc_status": None}, ["KYC_001"], [], "invalid_kyc_status;high_risk_incomplete_kyc"),
    ({"counterparty_risk_rating": "High", "kyc_status": "Pending"}, ["KYC_001"], ["SQL_KYC_001"], "high_risk_incomplete_kyc"),
    ({"counterparty_risk_rating": "Extreme"}, [], [], "invalid_counterparty_risk_rating"),
    ({"provider_confidence_score": "1.2"}, ["PROVIDER_001"], ["SQL_PROVIDER_001"], "invalid_provider_confidence_score"),
    ({"provider_confidence_score": "0.69"}, ["PROVIDER_002"], ["SQL_PROVIDER_002"], "low_provider_confidence_score"),
    ({"isin": "bad"}, ["SECURITY_001"], ["SQL_SECURITY_001"], ""),
    ({"lei": None}, ["ENTITY_001"], ["SQL_ENTITY_001"], ""),
    ({"last_verified_date": "2024-06-30"}, ["TIME_001"], [], ""),
    ({"last_verified_date": "2024-06-29"}, ["TIME_001"], ["SQL_TIME_001"], ""),
    ({"notional_amount": "10000000", "kyc_status": "Expired"}, [], ["SQL_REVIEW_001"], ""),
]


@pytest.fixture(scope="module")
def trades(spark):
    rows = []
    for i, (change, *_) in enumerate(VARIANTS):
        row = {**GOOD, "trade_id": f"T{i:02d}", **change}
        rows.append(tuple(row[c] for c in TRADE_COLUMNS))
    return spark.createDataFrame(rows, TRADE_LINKS)


@pytest.fixture(scope="module")
def with_duplicates(spark, trades):
    """One more pair of trades whose ids are equal once stripped."""
    twins = [tuple({**GOOD, "trade_id": t}[c] for c in TRADE_COLUMNS) for t in ("TWIN", "TWIN ")]
    return trades.unionByName(spark.createDataFrame(twins, TRADE_LINKS))


def expected_counts(position, twin_rule=None, twins=0):
    counts = {}
    for variant in VARIANTS:
        for rule in variant[position]:
            counts[rule] = counts.get(rule, 0) + 1
    if twin_rule:
        counts[twin_rule] = twins
    return counts


def test_onboarding_counts(with_duplicates):
    got = {r.rule_id: r.failed_count for r in validate_dataset(with_duplicates, TRADES, trade_rules(), as_of=AS_OF).collect()}
    assert len(got) == 19 and got.pop("SCHEMA_001") == 0
    assert {k: n for k, n in got.items() if n} == expected_counts(1, "TRADE_002", 2)


def test_exceptions_agree_with_counts(with_duplicates):
    rules = trade_rules()
    results = rule_results(with_duplicates, rules, "t", as_of=AS_OF)
    listed = exceptions(with_duplicates, rules, "trade_id", as_of=AS_OF)
    per_rule = {r.rule_id: r["count"] for r in listed.groupBy("rule_id").count().collect()}
    assert per_rule == {r.rule_id: r.failed_count for r in results.collect() if r.failed_count}
    assert all(r.passed_count + r.failed_count == r.total_count for r in results.collect())
    wide = wide_exceptions(with_duplicates, rules, "trade_id", as_of=AS_OF)
    assert wide.count() == listed.count() == run_summary(results).first().exceptions_generated
    only = wide.where("rule_id = 'SECURITY_001'").first()
    assert only.isin == "bad" and only.currency is None


def test_examples_are_the_first_in_key_order(with_duplicates):
    rules = trade_rules()
    examples = failed_examples(with_duplicates, rules, "trade_id", as_of=AS_OF, count=1)
    ids = {r.rule_id: r.record_id for r in examples.collect()}
    assert ids["TRADE_002"] == "TWIN" and ids["REF_001"] == "T10"
    shown = with_examples(rule_results(with_duplicates, rules, "t", as_of=AS_OF), examples)
    texts = {r.rule_id: r.failed_examples for r in shown.collect()}
    assert texts["DATE_001"] == '[{"trade_id":"T06","trade_date":"soon","settlement_date":"2025-01-04"}]'


def test_missing_column_stops_after_the_schema_rule(with_duplicates):
    got = validate_dataset(with_duplicates.drop("lei", "isin"), TRADES, trade_rules(), as_of=AS_OF).collect()
    assert [(r.rule_id, r.failed_count, r.total_count) for r in got] == [("SCHEMA_001", 2, 24)]
    assert "isin, lei" in got[0].recommendation


def test_sql_pack(with_duplicates):
    rules = trade_sql_rules(as_of=f"DATE'{AS_OF}'")
    got = {r.rule_id: r.failed_count for r in run_sql_rules(with_duplicates, rules, TRADES.name).collect()}
    # The SQL rule compares the ids as they are, so the twins differ by a space.
    assert {k: n for k, n in got.items() if n} == expected_counts(2)
    rows = sql_failed_rows(with_duplicates, rules, TRADES.name)
    assert rows.count() == sum(got.values())


def test_annotated_rules_run_and_errors_are_isolated(with_duplicates):
    rules = trade_sql_rules(as_of=f"DATE'{AS_OF}'")
    text = "-- A heading\n\n" + annotated_text(rules, TRADES.name)
    text += ("-- RULE_ID: BROKEN\n-- SEVERITY: Low\n-- DIMENSION: Schema\n-- DESCRIPTION: d\n-- RECOMMENDATION: r\n"
             f"SELECT nothing FROM {TRADES.name};\n")
    text += ("-- RULE_ID: FAILS_LATE\n-- SEVERITY: Low\n-- DIMENSION: Schema\n-- DESCRIPTION: d\n-- RECOMMENDATION: r\n"
             f"SELECT trade_id FROM {TRADES.name} WHERE CAST(notional_amount AS INT) = CAST(currency AS INT);\n")
    parsed = read_annotated_rules(text)
    assert [r.rule_id for r in parsed] == [*[r.rule_id for r in rules], "BROKEN", "FAILS_LATE"]
    got = {r.rule_id: r for r in run_sql_rules(with_duplicates, parsed, TRADES.name).collect()}
    total = len(VARIANTS) + 2
    for broken in ("BROKEN", "FAILS_LATE"):
        assert (got[broken].status, got[broken].failed_count) == ("error", total)
        assert got[broken].error_message
    assert got["SQL_REF_001"].failed_count == 3 and got["SQL_TRADE_002"].status == "passed"
    with pytest.raises(ValueError):
        read_annotated_rules("SELECT 1;")


def test_rules_of_a_file_share_the_scan_where_they_mean_one_condition(spark, trades):
    trades.createOrReplaceTempView("lifting")
    parsed = read_annotated_rules(annotated_text(trade_sql_rules("lifting", f"DATE'{AS_OF}'"), "lifting"))
    assert [r.rule_id for r in parsed if not lifted(spark, r, "lifting").where] == ["SQL_TRADE_002"]
    for query in ("SELECT trade_id FROM lifting WHERE true LIMIT 1", "SELECT trade_id FROM lifting WHERE true GROUP BY trade_id",
                  "SELECT trade_id FROM lifting WHERE lei = 'x' ORDER BY trade_id", "SELECT trade_id AS id FROM lifting WHERE true",
                  "SELECT trade_id FROM lifting WHERE trade_id IN (SELECT lei FROM lifting)", "SELECT DISTINCT trade_id FROM lifting WHERE true",
                  "SELECT trade_id FROM lifting WHERE true UNION ALL VALUES ('x')"):
        assert lifted(spark, SqlRule("R", "", "", "", "", query=query), "lifting").query == query
    whole = lifted(spark, SqlRule("R", "", "", "", "", query="select * from lifting where lei = '--'' a'"), "lifting")
    assert not whole.where
    whole = lifted(spark, SqlRule("R", "", "", "", "", query="select * from lifting where lei = 'where x'"), "lifting")
    assert whole.where and list(whole.columns) == trades.columns


def test_result_shapes_reconcile(with_duplicates):
    results = rule_results(with_duplicates, trade_rules(), TRADES.name, as_of=AS_OF)
    for shape in (onboarding_shape, sql_shape):
        back = {r.rule_id: r for r in reconcile(shape(results)).collect()}
        assert back["REF_001"].table_name == TRADES.name
        assert back["REF_001"].pass_rate == pytest.approx(100 - 200 / 27, abs=0.01)
    assert failed_rules(results, "critical").count() == 3
    with pytest.raises(ValueError):
        failed_rules(results, limit=0)


def test_remediation_flags(trades):
    reviewed = remediation.remediate(trades)
    got = [r.remediation_flags for r in reviewed.orderBy("trade_id").collect()]
    want = sorted((({**GOOD, "trade_id": f"T{i:02d}", **v[0]}["trade_id"].strip(), v[3]) for i, v in enumerate(VARIANTS)))
    assert got == [w[1] for w in want]


def test_split_is_a_partition_and_blocking_flags_decide(with_duplicates):
    reviewed = remediation.remediate(with_duplicates)
    accepted, quarantined = remediation.split(reviewed)
    assert accepted.count() + quarantined.count() == with_duplicates.count()
    open_flags = {r.remediation_flags for r in accepted.collect()}
    assert open_flags == {"", "weak_counterparty_name", "low_provider_confidence_score"}
    twins = quarantined.where("trade_id = 'TWIN'").collect()
    assert [t.remediation_flags for t in twins] == ["duplicate_trade_id"] * 2
    fixed = {r.currency for r in reviewed.collect()}
    assert fixed == {"USD", "EUR", "XXX"}
    summary = curation_summary(reviewed).first()
    assert summary.curated_records + summary.quarantine_records == summary.total_records
    top = remediation.top_flags(reviewed).collect()
    assert [r.records for r in top] == sorted((r.records for r in top), reverse=True)


def test_core_pack_null_semantics(spark):
    def frame(table, rows):
        schema = TABLES[table]
        full = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
        return spark.createDataFrame(full, schema)

    tables = {
        "entities": frame("entities", [{"entity_id": "E1", "registration_number": "R1"}, {"entity_id": "E1"}, {}, {}]),
        "issuers": frame("issuers", [{"issuer_id": "I1", "entity_id": "E1"}, {"issuer_id": "I2", "entity_id": None}]),
        "entity_hierarchy": frame("entity_hierarchy", [
            {"child_entity_id": "E1", "parent_entity_id": "E1", "ownership_percentage": 100.0},
            {"child_entity_id": "E1", "parent_entity_id": None, "ownership_percentage": None}]),
        "kyc_attributes": frame("kyc_attributes", [{}]),
        "provider_feed": frame("provider_feed", [
            {"registration_number": "R1"}, {"registration_number": "R2"}, {"registration_number": None}]),
    }
    got = {r.rule_id: r.failed_count for r in evaluate_pack(tables, CORE_PACK, AS_OF).collect()}
    assert len(got) == 27
    assert got["ENT-001"] == 2 and got["ENT-002"] == 4  # missing ids are equal to each other
    assert got["ENT-004"] == 4 and got["ENT-007"] == 0 and got["ENT-008"] == 0
    assert got["ISS-003"] == 1 and got["HIER-002"] == 1 and got["HIER-003"] == 1 and got["HIER-005"] == 1
    assert got["HIER-004"] == 1 and got["KYC-001"] == 1 and got["KYC-002"] == 1 and got["KYC-004"] == 0
    assert got["PRV-001"] == 3 and got["PRV-003"] == 3 and got["PRV-004"] == 1
    # Two entity rows share E1, so its issuer counts twice.
    linked = issuer_linkage(tables["issuers"], tables["entities"]).first()
    assert (linked.total_issuer_records, linked.orphan_issuer_count) == (3, 1)


def test_curation_is_counted_as_the_rows_say(trades, with_duplicates):
    for df in (trades, with_duplicates, with_duplicates.limit(0)):
        reviewed = remediation.remediate(df)
        assert remediation.curation_counts(df).collect() == curation_summary(reviewed).collect()
        assert remediation.flag_counts(df).collect() == remediation.top_flags(reviewed).collect()


def test_examples_are_the_first_rows_whatever_ties_and_missing_ids(spark, trades):
    more = trades.unionByName(trades.withColumn("trade_id", F.lit("SAME"))).unionByName(trades.withColumn("trade_id", F.lit(None).cast("string")))
    for count in (1, 3, 5):
        want = {}
        for r in exceptions(more, trade_rules(), "trade_id", as_of=AS_OF).collect():
            want.setdefault(r.rule_id, []).append((r.record_id is not None, r.record_id or "", r.evidence))
        got = {}
        for r in failed_examples(more, trade_rules(), "trade_id", as_of=AS_OF, count=count).orderBy("rule_id", "example_no").collect():
            got.setdefault(r.rule_id, []).append((r.record_id is not None, r.record_id or "", r.evidence))
        assert got == {k: sorted(v)[:count] for k, v in want.items()}


def test_failing_rows_of_rules_that_break_while_running(with_duplicates):
    from plumbline.rules.trades_sql import SqlRule

    def rule(rule_id, query):
        return SqlRule(rule_id, "Low", "Schema", "d", "r", query=query)

    view = TRADES.name
    good = list(trade_sql_rules(as_of=f"DATE'{AS_OF}'"))
    bad = [
        rule("CONDITION", f"SELECT trade_id FROM {view} WHERE CAST(currency AS INT) = 1"),
        rule("ONE_ROW", f"SELECT trade_id FROM {view} WHERE 1 / if(trade_id = 'T10', 0, 1) > 5"),
        rule("LIST", f"SELECT CAST(concat('x', trade_id) AS INT) AS n FROM {view}"),
        rule("COMPILES_NOT", f"SELECT nothing FROM {view}"),
    ]
    results, failed = run_sql_pack(with_duplicates, [bad[0], *good[:7], bad[1], *good[7:], *bad[2:]], view)
    status = {r.rule_id: (r.status, r.failed_count, bool(r.error_message)) for r in results.collect()}
    assert all(status[r.rule_id] == ("error", len(VARIANTS) + 2, True) for r in bad)
    want = sql_failed_rows(with_duplicates, good, view)
    assert sorted(map(str, failed.select("rule_id", "trade_id").collect())) == sorted(map(str, want.select("rule_id", "trade_id").collect()))
    # Rules that find nothing leave an empty result with its facts.
    nothing = run_sql_pack(with_duplicates, [rule("NONE", f"SELECT trade_id FROM {view} WHERE false")], view)[1]
    assert nothing.columns[:4] == ["rule_id", "severity", "dimension", "issue_type"] and nothing.count() == 0
