"""The two batch jobs: the core run and the full run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from plumbline.model import DatasetSpec
from plumbline.operators import anomaly, marts, profiling, remediation, reports
from plumbline.operators.evaluate import (
    AsOf, core_shape, evaluate_pack, exceptions, failed_examples, onboarding_shape, results_of_exceptions, sql_shape, union_all, validate_dataset, with_examples,
)
from plumbline.operators.scoring import scorecard, table_summary
from plumbline.operators.sqlrules import run_sql_pack
from plumbline.functions.dates import as_of_sql
from plumbline.rules.core import CORE_KEYS, CORE_PACK
from plumbline.rules.registered import spec_rules
from plumbline.rules.trades import TRADES, trade_rules
from plumbline.rules.trades_sql import SqlRule, trade_sql_rules
from plumbline.sources.sinks import write_curated, write_report


def _kept(df: DataFrame, folder: str, report: str) -> DataFrame:
    """Write a report and continue from what was written, so that nothing is computed twice."""
    return df.sparkSession.read.parquet(write_report(df, f"{folder}/{report}"))


def core_job(tables: dict[str, DataFrame], folder: str, as_of: AsOf = None) -> dict[str, DataFrame]:
    """Profile, validate, score, rank anomalies and summarise the five core tables.

    Every stage writes its report below ``folder``; the scorecard reads the written results.
    """
    out: dict[str, DataFrame] = {}
    profiles = union_all([profiling.profile(tables[t], t) for t in CORE_PACK])
    out["profile_summary"] = _kept(profiles, folder, "profile_summary")
    results = evaluate_pack(tables, CORE_PACK, as_of)
    examples = union_all([failed_examples(tables[t], CORE_PACK[t], key, tables, as_of) for t, key in CORE_KEYS.items()])
    out["rule_results"] = _kept(with_examples(core_shape(results), examples), folder, "rule_results")
    out["quality_scorecard"] = _kept(scorecard(out["rule_results"]), folder, "quality_scorecard")
    out["table_quality_summary"] = _kept(table_summary(out["quality_scorecard"]), folder, "table_quality_summary")
    ranked = anomaly.anomalies(anomaly.score_entities(tables["entities"], as_of))
    out["entity_anomalies"] = _kept(ranked, folder, "entity_anomalies")
    out["kpi_snapshot"] = reports.kpi_snapshot(out["table_quality_summary"])
    out["lowest_tables"] = reports.lowest_tables(out["table_quality_summary"])
    out["most_failed_rules"] = reports.most_failed(out["rule_results"])
    out["critical_failures"] = reports.critical_failures(out["rule_results"])
    out["mart_entity_quality_summary"] = _kept(
        marts.entity_quality_summary(tables["entities"], as_of), folder, "mart_entity_quality_summary")
    out["mart_quality_exceptions"] = _kept(
        marts.quality_exceptions(tables, as_of), folder, "mart_quality_exceptions")
    return out


def onboarding_job(df: DataFrame, folder: str, spec: DatasetSpec = TRADES, as_of: AsOf = None) -> dict[str, DataFrame]:
    """Profile and validate an incoming dataset and list its exceptions.

    Trades have their pack; any other registered dataset is checked by the rules that its specification implies.
    """
    rules = trade_rules(spec) if spec.name == TRADES.name else spec_rules(spec, df.columns)
    out = {"column_profile": _kept(
        profiling.onboarding_profile(df, spec.name, spec.primary_key), folder, f"{spec.name}_column_profile")}
    if spec.missing_columns(df.columns) or len({r.rule_id for r in rules}) < len(rules):
        results = validate_dataset(df, spec, rules, as_of=as_of)
    else:
        failed = _kept(exceptions(df, rules, spec.primary_key, as_of=as_of), folder, f"{spec.name}_failed_records")
        results = results_of_exceptions(failed, df, spec, rules)
    out["rule_results"] = _kept(results, folder, f"{spec.name}_rule_results_full")
    out["run_summary"] = _kept(reports.run_summary(out["rule_results"], len(df.columns)), folder, f"{spec.name}_run_summary")
    out["rule_results"] = _kept(onboarding_shape(out["rule_results"]), folder, f"{spec.name}_rule_results")
    if not spec.missing_columns(df.columns):
        if len({r.rule_id for r in rules}) < len(rules):
            failed = _kept(exceptions(df, rules, spec.primary_key, as_of=as_of), folder, f"{spec.name}_failed_records")
        out["failed_records"] = failed
    return out


def sql_job(
    df: DataFrame, folder: str, view: str = TRADES.name, as_of: AsOf = None, rules: Sequence[SqlRule] = ()
) -> dict[str, DataFrame]:
    """Run rules written as SQL, by default the trades pack, and keep their results and failing rows."""
    results, failed = run_sql_pack(
        df, rules or trade_sql_rules(view, as_of_sql(as_of)), view, lambda rows: _kept(rows, folder, f"sql_{view}_failed_records"))
    return {"rule_results": _kept(sql_shape(results), folder, f"sql_{view}_rule_results"), "failed_records": failed}


def remediation_job(df: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Standardise, flag and split; the summaries read the written output."""
    spark = df.sparkSession
    reviewed = spark.read.parquet(write_curated(remediation.remediate(df), f"{folder}/curated"))
    accepted, quarantined = remediation.split(reviewed)
    return {
        "curated": accepted,
        "quarantined": quarantined,
        "summary": reports.curation_summary(reviewed),
        "top_flags": remediation.top_flags(reviewed),
    }


# The stages of the full run, in order.
STAGES: dict[str, Callable] = {
    "core": lambda tables, folder, as_of: core_job(tables, folder, as_of),
    "onboarding": lambda tables, folder, as_of: onboarding_job(tables[TRADES.name], folder, as_of=as_of),
    "sql": lambda tables, folder, as_of: sql_job(tables[TRADES.name], folder, as_of=as_of),
    "remediation": lambda tables, folder, as_of: remediation_job(tables[TRADES.name], folder),
}


def full_job(tables: dict[str, DataFrame], folder: str, as_of: AsOf = None) -> dict[str, dict[str, DataFrame]]:
    """Core run, onboarding, SQL rules and remediation, one after the other."""
    return {stage: run(tables, f"{folder}/{stage}", as_of) for stage, run in STAGES.items()}
