"""Scorecards by table and dimension, table summaries and status bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import exact_mean_sql, round_even_sql

# Lower bounds of the status bands.
GOOD_FROM = 90
MONITOR_FROM = 80


def status_band(score: str) -> str:
    return (
        f"CASE WHEN {score} >= {GOOD_FROM} THEN 'Good' WHEN {score} >= {MONITOR_FROM} THEN 'Monitor' "
        "ELSE 'Needs Attention' END"
    )


def scorecard(results: DataFrame) -> DataFrame:
    """Rule results grouped by table and dimension. Pass rates are rounded before they are averaged."""
    grouped = results.groupBy("table_name", "dimension").agg(
        F.expr("count(rule_id) AS rule_count"),
        F.expr("sum(total_count) AS total_records_checked"),
        F.expr("sum(failed_count) AS total_failed_records"),
        F.expr(f"{exact_mean_sql('pass_rate', 4)} AS average_pass_rate"),
    )
    scored = grouped.selectExpr("*", f"{round_even_sql('average_pass_rate * 100.0D', 2)} AS quality_score")
    return scored.selectExpr("*", f"{status_band('quality_score')} AS status")


def table_summary(card: DataFrame) -> DataFrame:
    """Scorecard grouped by table; the dimensions of a table weigh the same."""
    grouped = card.groupBy("table_name").agg(
        F.expr("count(DISTINCT dimension) AS dimensions_checked"),
        F.expr("sum(rule_count) AS total_rules"),
        F.expr("sum(total_failed_records) AS total_failed_records"),
        F.expr(f"{round_even_sql(exact_mean_sql('quality_score', 2), 2)} AS overall_quality_score"),
    )
    return grouped.selectExpr("*", f"{status_band('overall_quality_score')} AS status")
