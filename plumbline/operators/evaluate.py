"""Evaluation of rules: one aggregate per table for counts, one exploded scan for exceptions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.dates import as_of_sql
from plumbline.functions.numbers import percentage_sql, round_even_sql
from plumbline.functions.predicates import RowCheck
from plumbline.functions.text import literal, literals, name
from plumbline.model import DatasetSpec, Rule
from plumbline.operators.keys import mark_rows

AsOf = dt.date | str | None

RESULT_COLUMNS = (
    "table_name", "rule_id", "dimension", "severity", "description", "total_count", "failed_count",
    "passed_count", "pass_rate", "failure_rate_pct", "status", "error_message", "recommendation",
)


def union_all(frames: Sequence[DataFrame], ragged: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=ragged), frames)


def rule_results(
    df: DataFrame,
    rules: Sequence[Rule],
    table_name: str,
    refs: dict[str, DataFrame] | None = None,
    as_of: AsOf = None,
) -> DataFrame:
    """One row per rule with its counts, rates and reporting facts."""
    return finish_results(rule_counts([(table_name, df, rules)], refs, as_of))


def rule_counts(
    parts: Sequence[tuple[str, DataFrame, Sequence[Rule]]],
    refs: dict[str, DataFrame] | None = None,
    as_of: AsOf = None,
) -> DataFrame:
    """One row per rule with the rows checked and failed, for any number of tables.

    All row-local rules of a table share a single scan and a single aggregate. A key rule reads only
    its key columns; its groups go straight into the final sum, which is one shuffle for all rules.
    """
    when = as_of_sql(as_of)
    facts: list[str] = []
    frames: list[DataFrame] = []
    for table_name, df, rules in parts:
        aggregates, lines = ["count(*) AS total"], []
        for r in rules:
            number, failed = len(facts), "0L"
            facts.append(_facts(table_name, r))
            if isinstance(r.check, RowCheck):
                failed = f"f{number}"
                aggregates.append(f"count_if({r.check.failed(when)}) AS {failed}")
            else:
                groups = r.check.judged_groups(df.select(*r.check.reads()), refs or {})
                frames.append(groups.selectExpr(
                    f"{number} AS rule_no", "0L AS total_count", "CASE WHEN __bad THEN __rows ELSE 0L END AS failed_count"
                ))
            lines.append(f"{number}, total, {failed}")
        counted = df.agg(*map(F.expr, aggregates))
        frames.append(counted.selectExpr(
            f"stack({len(lines)}, {', '.join(lines)}) AS (rule_no, total_count, failed_count)"
        ))
    merged = union_all(frames)
    if len(frames) > len(parts):
        merged = merged.groupBy("rule_no").agg(
            F.expr("sum(total_count) AS total_count"), F.expr("sum(failed_count) AS failed_count")
        )
    named = merged.selectExpr(
        f"element_at(array({', '.join(facts)}), rule_no + 1) AS fact", "total_count", "failed_count"
    )
    return named.selectExpr("fact.*", "total_count", "failed_count")


def _facts(table_name: str, rule: Rule) -> str:
    facts = {
        "table_name": table_name,
        "rule_id": rule.rule_id,
        "dimension": rule.dimension,
        "severity": rule.severity,
        "description": rule.description,
        "recommendation": rule.recommendation,
    }
    return f"named_struct({', '.join(f'{literal(k)}, {literal(v)}' for k, v in facts.items())})"


def finish_results(counts: DataFrame) -> DataFrame:
    """Derive passed rows, rates and status from the two counts."""
    passed = "(total_count - failed_count)"
    rate = round_even_sql(f"CAST({passed} AS DOUBLE) / CAST(total_count AS DOUBLE)", 4)
    derived = {
        "passed_count": passed,
        "pass_rate": f"CASE WHEN total_count = 0 THEN 1.0D ELSE {rate} END",
        "failure_rate_pct": percentage_sql("failed_count", "total_count"),
    }
    if "status" not in counts.columns:
        derived["status"] = "CASE WHEN failed_count > 0 THEN 'failed' ELSE 'passed' END"
        derived["error_message"] = "''"
    return counts.selectExpr(*[f"{derived[c]} AS {c}" if c in derived else c for c in RESULT_COLUMNS])


def evaluate_pack(
    tables: dict[str, DataFrame], pack: dict[str, Sequence[Rule]], as_of: AsOf = None
) -> DataFrame:
    """Results of a rule pack over several tables; the tables also serve as reference masters."""
    return finish_results(rule_counts([(t, tables[t], rules) for t, rules in pack.items()], tables, as_of))


def schema_result(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The required-columns rule: failed are the missing columns, total the required ones."""
    missing = spec.missing_columns(df.columns)
    advice = (
        "Supply the missing columns or change the registered schema: " + ", ".join(missing)
        if missing
        else "All required columns are present."
    )
    rule = Rule("SCHEMA_001", "Schema", "Critical", None, "The dataset has every required column.", advice)
    counts = (f"{len(spec.required_columns)}L AS total_count", f"{len(missing)}L AS failed_count")
    return finish_results(df.sparkSession.range(1).selectExpr(f"inline(array({_facts(spec.name, rule)}))", *counts))


def validate_dataset(
    df: DataFrame,
    spec: DatasetSpec,
    rules: Sequence[Rule],
    refs: dict[str, DataFrame] | None = None,
    as_of: AsOf = None,
) -> DataFrame:
    """Schema rule first; the other rules run only when no required column is missing."""
    schema = schema_result(df, spec)
    if spec.missing_columns(df.columns):
        return schema
    return schema.unionByName(rule_results(df, rules, spec.name, refs, as_of))


def results_of_exceptions(failed: DataFrame, df: DataFrame, spec: DatasetSpec, rules: Sequence[Rule]) -> DataFrame:
    """As ``validate_dataset``, from the written exceptions of all rules: each failing row is one of them, so none is looked for again."""
    facts = df.agg(F.expr("count(*) AS total_count")).selectExpr(
        f"explode(array({', '.join(_facts(spec.name, r) for r in rules)})) AS fact", "total_count").selectExpr("fact.*", "total_count")
    found = failed.groupBy("rule_id").agg(F.expr("count(*) AS failed_count"))
    counts = facts.join(F.broadcast(found), "rule_id", "left").fillna(0, ["failed_count"])
    return schema_result(df, spec).unionByName(finish_results(counts))


def exceptions(
    df: DataFrame,
    rules: Sequence[Rule],
    record_key: str,
    refs: dict[str, DataFrame] | None = None,
    as_of: AsOf = None,
    table_name: str | None = None,
) -> DataFrame:
    """One row per failing row and rule, the evidence columns packed as JSON.

    Row-local rules are decided in one scan without a shuffle; every key rule adds a scan of the
    columns that it reports.
    """
    hits = _hits(df, rules, record_key, refs or {}, as_of, evidence=True)
    if table_name is not None:
        hits = hits.select(F.lit(table_name).alias("table_name"), "*")
    return hits


def wide_exceptions(
    df: DataFrame,
    rules: Sequence[Rule],
    record_key: str,
    refs: dict[str, DataFrame] | None = None,
    as_of: AsOf = None,
) -> DataFrame:
    """Exceptions with one column per evidence column, null where a rule does not report it."""
    hits = _hits(df, rules, record_key, refs or {}, as_of, evidence=False)
    shown = []
    for c in _evidence(df, rules):
        reporting = literals([r.rule_id for r in rules if c in r.evidence])
        shown.append(f"CASE WHEN rule_id IN ({reporting}) THEN {name('__e_' + c)} END AS {name(c)}")
    return hits.selectExpr("rule_id", "issue_type", "severity", "dimension", "record_id", *shown)


def _hits(df, rules, record_key, refs, as_of, evidence):
    when = as_of_sql(as_of)
    row_rules = [r for r in rules if isinstance(r.check, RowCheck)]
    frames = []
    if row_rules:
        kept = dict.fromkeys([record_key, *_evidence(df, row_rules)])
        failing = spread_rules(df, kept, [r.check.failed(when) for r in row_rules])
        frames.append(_spread(failing, _hit_of_rule(row_rules, df, evidence), row_rules, record_key, evidence))
    for r in rules:
        if isinstance(r.check, RowCheck):
            continue
        needed = list(dict.fromkeys([record_key, *r.check.reads(), *_evidence(df, [r])]))
        failing = mark_rows(df.select(*needed), r.check, refs, "__failed").where("__failed")
        frames.append(_spread(failing, _hit(r, df, evidence), [r], record_key, evidence))
    return union_all(frames, ragged=not evidence)


def spread_rules(df: DataFrame, columns: Iterable[str], conditions: Sequence[str]) -> DataFrame:
    """Some columns of each row, once for every condition that it meets, with the condition's number as ``__rule``.

    The numbers are listed as one text, which skips conditions that are not met, so that only hits, or one line for a row
    without any, are ever made.
    """
    met = ", ".join(f"CASE WHEN {c} THEN '{i}' END" for i, c in enumerate(conditions))
    lines = df.selectExpr(*map(name, columns), f"explode(split(concat_ws(',', {met}), ',')) AS __met").where("__met <> ''")
    return lines.selectExpr(*map(name, columns), "try_cast(__met AS INT) AS __rule")


def _spread(df: DataFrame, hit: str, rules: Sequence[Rule], record_key: str, evidence: bool) -> DataFrame:
    """Hit structs as columns, next to the record id and, for wide output, the evidence columns."""
    kept = [] if evidence else _evidence(df, rules)
    rows = df.selectExpr(
        f"{name(record_key)} AS record_id", *[f"{name(c)} AS {name('__e_' + c)}" for c in kept], f"{hit} AS __hit"
    )
    return rows.selectExpr("__hit.*", "record_id", *[name("__e_" + c) for c in kept])


def _hit(rule: Rule, df: DataFrame, evidence: bool) -> str:
    facts = {
        "rule_id": rule.rule_id,
        "issue_type": rule.issue,
        "severity": rule.severity,
        "dimension": rule.dimension,
    }
    fields = ", ".join(f"'{k}', {literal(v)}" for k, v in facts.items())
    if evidence:
        packed = ", ".join(map(name, _evidence(df, [rule])))
        fields += f", 'evidence', to_json(struct({packed}), map('ignoreNullFields', 'false'))"
    return f"named_struct({fields})"


def _hit_of_rule(rules: Sequence[Rule], df: DataFrame, evidence: bool) -> str:
    """The hit of the rule with the number ``__rule``."""
    return f"CASE __rule {' '.join(f'WHEN {i} THEN {_hit(r, df, evidence)}' for i, r in enumerate(rules))} END"


def _evidence(df: DataFrame, rules: Sequence[Rule]) -> list[str]:
    return list(dict.fromkeys(c for r in rules for c in r.evidence if c in df.columns))


def failed_examples(
    df: DataFrame,
    rules: Sequence[Rule],
    record_key: str,
    refs: dict[str, DataFrame] | None = None,
    as_of: AsOf = None,
    count: int = 5,
) -> DataFrame:
    """The first failing rows of every rule in key order, at most ``count`` per rule.

    Failing rows are ranked by record id first, of which tasks keep the first before the shuffle. Evidence is packed for
    those alone; rows that repeat the last of these ids are all compared by their evidence.
    """
    refs = refs or {}
    row_rules = [r for r in rules if isinstance(r.check, RowCheck)]
    others = [r for r in rules if not isinstance(r.check, RowCheck)]
    frames = []
    if row_rules:
        frames.append(_first_of_row_rules(df, row_rules, record_key, as_of, count))
    for r in others:
        needed = list(dict.fromkeys([record_key, *r.check.reads(), *_evidence(df, [r])]))
        failing = mark_rows(df.select(*needed), r.check, refs, "__failed").where("__failed")
        first = failing.withColumn("__rule", F.lit(0)).withColumn(
            "__place", F.rank().over(Window.partitionBy("__rule").orderBy(name(record_key)))).where(F.col("__place") <= count)
        frames.append(_spread(first, _hit(r, df, True), [r], record_key, True))
    order = Window.partitionBy("rule_id").orderBy("record_id", "evidence")
    hits = union_all(frames).select("rule_id", "record_id", "evidence")
    return hits.withColumn("example_no", F.row_number().over(order)).where(F.col("example_no") <= count)


def _first_of_row_rules(df: DataFrame, rules: Sequence[Rule], record_key: str, as_of: AsOf, count: int) -> DataFrame:
    """Hits with evidence of the first failing rows of each rule by record id, and of all rows with the last of these ids."""
    when, kept = as_of_sql(as_of), _evidence(df, rules)
    failing = spread_rules(df, dict.fromkeys([record_key, *kept]), [r.check.failed(when) for r in rules])
    first = failing.withColumn("__place", F.rank().over(Window.partitionBy("__rule").orderBy(name(record_key)))).where(
        F.col("__place") <= count)
    return _spread(first, _hit_of_rule(rules, df, True), rules, record_key, True)


def with_examples(results: DataFrame, examples: DataFrame) -> DataFrame:
    """Attach the example rows to the results as one JSON list per rule."""
    ordered = "sort_array(collect_list(struct(example_no, evidence))).evidence"
    texts = examples.groupBy("rule_id").agg(F.expr(f"'[' || array_join({ordered}, ', ') || ']' AS shown"))
    return results.join(texts, "rule_id", "left").selectExpr(
        *results.columns, "coalesce(shown, '[]') AS failed_examples"
    )


def core_shape(results: DataFrame) -> DataFrame:
    """Rule results with pass rates."""
    return results.select(
        "table_name", "rule_id", "dimension", "severity", "description", "total_count",
        "failed_count", "passed_count", "pass_rate", "recommendation",
    )


def onboarding_shape(results: DataFrame) -> DataFrame:
    """Rule results with failure percentages and the time of validation."""
    return results.select(
        F.col("table_name").alias("dataset_name"), "rule_id", "dimension", "severity", "description",
        F.col("total_count").alias("total_rows"), "failed_count", "failure_rate_pct", "recommendation",
        F.current_timestamp().alias("validated_at"),
    )


def sql_shape(results: DataFrame) -> DataFrame:
    """The onboarding shape plus the outcome of running the rule."""
    return results.select(
        F.col("table_name").alias("dataset_name"), "rule_id", "severity", "dimension", "description",
        "recommendation", F.col("total_count").alias("total_rows"), "failed_count", "failure_rate_pct",
        "status", "error_message", F.current_timestamp().alias("validated_at"),
    )


def reconcile(results: DataFrame) -> DataFrame:
    """Bring any of the three result shapes to the columns that displays need."""
    out = results
    if "table_name" not in out.columns:
        out = out.withColumnRenamed("dataset_name", "table_name")
    if "pass_rate" not in out.columns:
        out = out.withColumn("pass_rate", F.lit(100.0) - F.col("failure_rate_pct"))
    return out.select(
        "table_name", "rule_id", "dimension", "severity", "description", "failed_count", "pass_rate",
        "recommendation",
    )
