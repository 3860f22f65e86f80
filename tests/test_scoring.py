"""Rounding and scores; the 27 recorded rule results have to give the recorded scores."""

import pytest

from plumbline.functions.numbers import round_even
from plumbline.operators.evaluate import finish_results
from plumbline.operators.reports import kpi_snapshot, lowest_tables, most_failed
from plumbline.operators.scoring import scorecard, table_summary

# Table, rule, dimension, rows, failed rows.
RECORDED = """
entities ENT-001 Completeness 5100 0
entities ENT-002 Uniqueness 5100 200
entities ENT-003 Completeness 5100 75
entities ENT-004 Validity 5100 126
entities ENT-005 Validity 5100 78
entities ENT-006 Validity 5100 50
entities ENT-007 Validity 5100 51
entities ENT-008 Timeliness 5100 3611
entities ENT-009 Completeness 5100 110
issuers ISS-001 Completeness 1515 0
issuers ISS-002 Uniqueness 1515 30
issuers ISS-003 Referential_Integrity 1515 26
issuers ISS-004 Validity 1515 54
issuers ISS-005 Completeness 1515 92
entity_hierarchy HIER-001 Referential_Integrity 2020 26
entity_hierarchy HIER-002 Referential_Integrity 2020 23
entity_hierarchy HIER-003 Validity 2020 21
entity_hierarchy HIER-004 Validity 2020 270
entity_hierarchy HIER-005 Hierarchy_Integrity 2020 61
kyc_attributes KYC-001 Referential_Integrity 4250 64
kyc_attributes KYC-002 Validity 4250 204
kyc_attributes KYC-003 Timeliness 4250 1209
kyc_attributes KYC-004 Timeliness 4250 2697
provider_feed PRV-001 Uniqueness 3857 114
provider_feed PRV-002 Completeness 3857 78
provider_feed PRV-003 Validity 3857 564
provider_feed PRV-004 Consistency 3857 0
"""

# Table, dimension, rules, rows checked, failed rows, mean pass rate, score, status.
SCORES = """
entities Completeness 3 15300 185 0.9879 98.79 Good
entities Timeliness 1 5100 3611 0.292 29.2 Needs_Attention
entities Uniqueness 1 5100 200 0.9608 96.08 Good
entities Validity 4 20400 305 0.98505 98.5 Good
entity_hierarchy Hierarchy_Integrity 1 2020 61 0.9698 96.98 Good
entity_hierarchy Referential_Integrity 2 4040 49 0.98785 98.78 Good
entity_hierarchy Validity 2 4040 291 0.92795 92.8 Good
issuers Completeness 2 3030 92 0.96965 96.96 Good
issuers Referential_Integrity 1 1515 26 0.9828 98.28 Good
issuers Uniqueness 1 1515 30 0.9802 98.02 Good
issuers Validity 1 1515 54 0.9644 96.44 Good
kyc_attributes Referential_Integrity 1 4250 64 0.9849 98.49 Good
kyc_attributes Timeliness 2 8500 3906 0.54045 54.04 Needs_Attention
kyc_attributes Validity 1 4250 204 0.952 95.2 Good
provider_feed Completeness 1 3857 78 0.9798 97.98 Good
provider_feed Consistency 1 3857 0 1.0 100.0 Good
provider_feed Uniqueness 1 3857 114 0.9704 97.04 Good
provider_feed Validity 1 3857 564 0.8538 85.38 Monitor
"""

# Table, dimensions, rules, failed rows, score, status.
SUMMARY = """
entities 4 9 4301 80.64 Monitor
entity_hierarchy 3 5 401 96.19 Good
issuers 4 5 202 97.42 Good
kyc_attributes 3 4 4174 82.58 Monitor
provider_feed 4 4 756 95.1 Good
"""



@pytest.fixture(scope="module")
def results(spark):
    rows = []
    for line in RECORDED.strip().splitlines():
        t, rule, dimension, total, failed = line.split()
        rows.append((t, rule, dimension.replace("_", " "), "High", "", "", int(total), int(failed)))
    return finish_results(spark.createDataFrame(
        rows, "table_name STRING, rule_id STRING, dimension STRING, severity STRING, description STRING, "
              "recommendation STRING, total_count BIGINT, failed_count BIGINT"))


def test_scorecard_matches_the_recorded_run(results):
    got = {(r.table_name, r.dimension): r for r in scorecard(results).collect()}
    lines = [line.split() for line in SCORES.strip().splitlines()]
    assert len(got) == len(lines) == 18
    for t, dimension, rules, rows, failed, mean, score, status in lines:
        r = got[t, dimension.replace("_", " ")]
        assert (r.rule_count, r.total_records_checked, r.total_failed_records) == (int(rules), int(rows), int(failed))
        assert r.average_pass_rate == pytest.approx(float(mean), abs=1e-12)
        assert (r.quality_score, r.status) == (float(score), status.replace("_", " "))


def test_summary_matches_the_recorded_run(results):
    got = {r.table_name: tuple(r)[1:] for r in table_summary(scorecard(results)).collect()}
    want = {}
    for line in SUMMARY.strip().splitlines():
        t, dims, rules, failed, score, status = line.split()
        want[t] = (int(dims), int(rules), int(failed), float(score), status)
    assert got == want


def test_snapshot_and_rankings(results):
    summary = table_summary(scorecard(results))
    assert tuple(kpi_snapshot(summary).first()) == (5, 27, 90.39, 9834)
    assert lowest_tables(summary).first().table_name == "entities"
    assert [r.rule_id for r in most_failed(results, 3).collect()] == ["ENT-008", "KYC-004", "KYC-003"]


def test_rounding_is_half_even_on_the_scaled_value(spark):
    values = [98.505, 96.965, 98.785, 54.045, 0.125, 2.5]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    got = [r[0] for r in df.select(round_even("x", 2)).collect()]
    assert got == [98.5, 96.96, 98.78, 54.04, 0.12, 2.5]


def test_empty_table_passes(spark):
    row = [("t", "R", "Validity", "High", "", "", 0, 0)]
    r = finish_results(spark.createDataFrame(
        row, "table_name STRING, rule_id STRING, dimension STRING, severity STRING, description STRING, "
             "recommendation STRING, total_count BIGINT, failed_count BIGINT")).first()
    assert (r.pass_rate, r.failure_rate_pct, r.status) == (1.0, 0.0, "passed")
