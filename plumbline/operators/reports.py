"""Report datasets and serving queries over results that are already aggregated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import exact_mean_sql, percentage_sql, round_even_sql

MAX_ROWS = 500


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    """The first rows where the caller asks for a number of them, else all."""
    if limit is None:
        return df
    if not 1 <= limit <= MAX_ROWS:
        raise ValueError(f"limit must lie between 1 and {MAX_ROWS}, not {limit}")
    return df.limit(limit)


def kpi_snapshot(summary: DataFrame) -> DataFrame:
    """Tables, rules, mean score and failed checks of a table summary."""
    return summary.agg(
        F.expr("count(DISTINCT table_name) AS tables_checked"),
        F.expr("coalesce(sum(total_rules), 0L) AS rules_executed"),
        F.expr(f"{round_even_sql(exact_mean_sql('overall_quality_score', 2), 2)} AS average_quality_score"),
        F.expr("coalesce(sum(total_failed_records), 0L) AS failed_record_checks"),
    )


def lowest_tables(summary: DataFrame, n: int = 5) -> DataFrame:
    return summary.orderBy(F.col("overall_quality_score").asc(), "table_name").limit(n)


def most_failed(results: DataFrame, n: int = 10) -> DataFrame:
    """The rules with the most failing rows; ties in rule order."""
    return results.orderBy(F.col("failed_count").desc(), "rule_id").limit(n)


def critical_failures(results: DataFrame) -> DataFrame:
    failing = results.where((F.col("severity") == "Critical") & (F.col("failed_count") > 0))
    return failing.orderBy(F.col("failed_count").desc(), "rule_id")


def failed_rules(results: DataFrame, severity: str | None = None, limit: int | None = None) -> DataFrame:
    """Failing rules, worst first, optionally of one severity in any spelling of its case."""
    failing = results.where(F.col("failed_count") > 0)
    if severity:
        failing = failing.where(F.lower("severity") == severity.lower())
    return _limited(failing.orderBy(F.col("failed_count").desc(), "rule_id"), limit)


def select_rules(results: DataFrame, severities: list[str], dimensions: list[str]) -> DataFrame:
    """Failing rules of the chosen severities and dimensions."""
    return results.where(
        (F.col("failed_count") > 0) & F.col("severity").isin(*severities) & F.col("dimension").isin(*dimensions)
    )


def run_summary(results: DataFrame, columns: int | None = None) -> DataFrame:
    """How many rules ran and failed, and how many of them are critical or high.

    A rule raises one exception per failing row, so their number is the sum of the failed counts and the
    exception rows need not be counted. The schema rule counts columns and raises none. ``columns``, the number
    of columns of the data set, is reported where it is given.
    """
    failing = "failed_count > 0"
    checked = "rule_id <> 'SCHEMA_001'"
    return results.agg(
        F.expr("count(*) AS rules_executed"),
        F.expr(f"count_if({failing}) AS rules_with_failures"),
        F.expr(f"coalesce(sum(CASE WHEN {checked} THEN failed_count END), 0L) AS exceptions_generated"),
        F.expr(f"count_if({failing} AND severity = 'Critical') AS critical_rules_failing"),
        F.expr(f"count_if({failing} AND severity = 'High') AS high_rules_failing"),
        F.expr(f"coalesce(max(CASE WHEN {checked} THEN total_count END), 0L) AS total_rows"),
        *([] if columns is None else [F.lit(columns).cast("long").alias("total_columns")]),
    )


def top_anomalies(anomalies: DataFrame, limit: int | None = None) -> DataFrame:
    return _limited(anomalies.orderBy(F.col("anomaly_score").asc(), "entity_id"), limit)


def anomalies_by_source(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("source_system").agg(F.count(F.lit(1)).alias("anomaly_count"))


def preview(df: DataFrame, key: str, n: int = 100) -> DataFrame:
    """The first rows in the order of the key and then of all columns, so that ties have one order."""
    return df.orderBy(key, *df.columns).limit(n)


def curation_summary(reviewed: DataFrame) -> DataFrame:
    """Accepted and quarantined records with their rates."""
    accepted = "count_if(curation_status = 'accepted')"
    return reviewed.agg(
        F.expr("count(*) AS total_records"),
        F.expr("count_if(issue_count > 0) AS records_with_issues"),
        F.expr(f"{accepted} AS curated_records"),
        F.expr(f"count(*) - {accepted} AS quarantine_records"),
        F.expr(f"{percentage_sql(accepted, 'count(*)')} AS curated_rate_pct"),
        F.expr(f"{percentage_sql(f'(count(*) - {accepted})', 'count(*)')} AS quarantine_rate_pct"),
    )
