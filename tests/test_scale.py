"""What keeps the queries within time and disk on large tables, tested on small ones."""

from plumbline.operators import sqlrules
from plumbline.operators.evaluate import onboarding_shape, validate_dataset
from plumbline.operators.sqlrules import run_sql_rules
from plumbline.plans import jobs
from plumbline.rules.trades import TRADES, trade_rules
from plumbline.rules.trades_sql import SqlRule, trade_sql_rules
from plumbline.sources.sinks import write_curated
from registry.domain import domain_table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_base_tables_that_tasks_can_share_are_not_shuffled(spark, tmp_path):
    whole = spark.read.parquet(f"{SF}/customer.parquet")
    whole.repartition(40).write.parquet(f"{tmp_path}/customer.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", "4m")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
        parted, single = domain_table(spark, str(tmp_path), "entities"), domain_table(spark, SF, "entities")
        assert "Exchange" not in plan(parted) and "Exchange" in plan(single)
        assert sorted(map(str, parted.collect())) == sorted(map(str, single.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_curated_folders_are_written_without_a_sort(spark, tmp_path):
    own = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(own)
    df = spark.range(1000).selectExpr("id", "IF(id % 3 = 0, 'quarantined_for_review', 'accepted') AS curation_status")
    path = write_curated(df.repartition(3), str(tmp_path / "curated"))
    files = [p.name for p in (tmp_path / "curated").rglob("*.parquet")]
    assert files and all(".zstd." in f for f in files) and spark.conf.get(own) == before
    back = spark.read.parquet(path)
    assert {(r.id, r.curation_status) for r in back.collect()} == {(r.id, r.curation_status) for r in df.collect()}


def test_jobs_count_failing_rows_where_they_are_written(spark, tmp_path, monkeypatch):
    def refused(*args):
        raise AssertionError("the table was scanned again for its counts")

    df = domain_table(spark, SF, TRADES.name)
    expected = {r.rule_id: (r.total_rows, r.failed_count) for r in onboarding_shape(validate_dataset(df, TRADES, trade_rules())).collect()}
    by_sql = {r.rule_id: (r.total_count, r.failed_count, r.status) for r in run_sql_rules(df, trade_sql_rules(), TRADES.name).collect()}
    monkeypatch.setattr(jobs, "validate_dataset", refused)
    monkeypatch.setattr(sqlrules, "_run_isolated", refused)
    out = jobs.onboarding_job(df, str(tmp_path / "a"))
    assert {r.rule_id: (r.total_rows, r.failed_count) for r in out["rule_results"].collect()} == expected
    out = jobs.sql_job(df, str(tmp_path / "b"))
    assert {r.rule_id: (r.total_rows, r.failed_count, r.status) for r in out["rule_results"].collect()} == by_sql
    assert out["failed_records"].count() == sum(n for _, n, _ in by_sql.values())


def test_a_rule_that_breaks_while_rows_are_written_is_isolated(spark, tmp_path):
    df = spark.range(100).selectExpr("CAST(id AS STRING) AS k", "id")
    rules = [SqlRule("A", "Low", "d", "x", "y", ("k",), "id < 7"), SqlRule("B", "Low", "d", "x", "y", ("id",), "1 / (id - id) > 0"),
             SqlRule("C", "Low", "d", "x", "y", ("id",), "id < 0")]
    out = jobs.sql_job(df, str(tmp_path), "w", rules=rules)
    assert {(r.rule_id, r.failed_count, r.status) for r in out["rule_results"].collect()} == {("A", 7, "failed"), ("B", 100, "error"), ("C", 0, "passed")}
    assert out["failed_records"].count() == 7 and "id" not in out["failed_records"].columns
