"""Rules that break while running, isolated without repeating what is costly."""

from plumbline.operators import sqlrules
from plumbline.operators.sqlrules import run_sql_pack
from plumbline.rules.trades_sql import SqlRule


def test_broken_rules_leave_no_shuffle_files_and_part_by_kind(spark, monkeypatch):
    df = spark.range(200).selectExpr("CAST(id % 150 AS STRING) AS k", "id").repartition(4)
    heavy = SqlRule("H", "Low", "d", "x", "y", query="SELECT k FROM v LEFT SEMI JOIN (SELECT k AS j FROM v GROUP BY k HAVING count(*) > 1) ON k = j")
    rows = [SqlRule(f"R{i}", "Low", "d", "x", "y", ("k",), f"id % 10 = {i}") for i in range(8)]
    broken = SqlRule("B", "Low", "d", "x", "y", ("k",), "1 / (id - id) > 0")
    seen, counted, state = [], sqlrules._counted, []
    own = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def watched(df, part, view):
        seen.append([r.rule_id for r in part])
        state.append(spark.conf.get(own))
        return counted(df, part, view)

    monkeypatch.setattr(sqlrules, "_counted", watched)
    results, failed = run_sql_pack(df, [*rows[:4], heavy, broken, *rows[4:]], "v")
    got = {r.rule_id: (r.failed_count, r.status) for r in results.collect()}
    assert got == {**{f"R{i}": (20, "failed") for i in range(8)}, "H": (100, "failed"), "B": (200, "error")}
    # The SELECT that shuffles runs in the first job and once by itself, however often the conditions are halved.
    assert sum("H" in part for part in seen) == 2 and ["H"] in seen
    assert set(state) == {"true"} and spark.conf.get(own) != "true"
    assert failed.count() == 260
