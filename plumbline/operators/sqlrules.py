"""Rules written as SQL: reading an annotated file, running a pack, collecting failing rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import literal, name
from plumbline.operators.evaluate import finish_results, spread_rules, union_all
from plumbline.rules.trades_sql import SqlRule
from plumbline.session import shuffles_dropped

# The annotation names in front of each rule of a SQL file, in their order.
ANNOTATIONS = ("RULE_ID", "SEVERITY", "DIMENSION", "DESCRIPTION", "RECOMMENDATION")

_ANNOTATION = re.compile(r"^--\s*(" + "|".join(ANNOTATIONS) + r"):\s*(.+)$", re.IGNORECASE)

#: Columns of one table under a condition without comment or subquery.
_ROW_LOCAL = re.compile(
    r"\s*SELECT\s+(?P<columns>\*|[\w`]+(?:\s*,\s*[\w`]+)*)\s+FROM\s+[\w`]+\s+WHERE\s(?P<where>(?:(?!--|/\*|\bSELECT\b).)+)", re.IGNORECASE | re.DOTALL)

#: Comments, quoted texts and names, semicolons, and anything else sign by sign.
_TOKENS = re.compile(r"--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|;|.", re.DOTALL)


def _statements(text: str) -> list[str]:
    """The text between semicolons; those in comments, quoted texts and quoted names don't count."""
    parts = _TOKENS.findall(text)
    out, held = [], ""
    for part in parts:
        if part == ";":
            out.append(held)
            held = ""
        else:
            held += part
    return [*out, held]


def read_annotated_rules(text: str) -> list[SqlRule]:
    """Split a SQL file into rules: five annotation comments followed by one SELECT each.

    A statement that has some of the annotations but not all, or no SELECT, is an error, not skipped.
    """
    rules: list[SqlRule] = []
    for statement in _statements(text):
        facts: dict[str, str] = {}
        body: list[str] = []
        for line in statement.splitlines():
            note = _ANNOTATION.match(line.strip())
            if note:
                facts[note.group(1).upper()] = note.group(2).strip()
            elif not line.strip().startswith("--"):
                body.append(line)
        query = "\n".join(body).strip()
        if not facts and not query:
            continue
        missing = [a for a in ANNOTATIONS if a not in facts]
        if facts and (missing or not re.match(r"(?i)(select|with)\b", query)):
            raise ValueError(f"rule {facts.get('RULE_ID', '?')} lacks {', '.join(missing) or 'a SELECT'}")
        if facts:
            rules.append(SqlRule(
                facts["RULE_ID"], facts["SEVERITY"], facts["DIMENSION"], facts["DESCRIPTION"],
                facts["RECOMMENDATION"], query=query,
            ))
    if not rules:
        raise ValueError("no rule found: each needs " + ", ".join(ANNOTATIONS) + " and a SELECT")
    return rules


def annotated_text(rules: Sequence[SqlRule], view: str) -> str:
    """The inverse of ``read_annotated_rules``."""
    parts = []
    for r in rules:
        values = (r.rule_id, r.severity, r.dimension, r.description, r.recommendation)
        head = "\n".join(f"-- {name}: {value}" for name, value in zip(ANNOTATIONS, values))
        parts.append(f"{head}\n{r.sql(view).strip()};\n")
    return "\n".join(parts)


def run_sql_rules(df: DataFrame, rules: Sequence[SqlRule], view: str) -> DataFrame:
    """Run a pack against ``df``, registered under ``view``, and return one result row per rule.

    Conditions on single rows are counted together in one scan, every other SELECT by an aggregate
    of its own, and all of it is one job. A rule that does not compile is reported as an error with all
    rows failing, as is one that breaks while running, in its condition or in its SELECT list; the other rules
    still run. Only the counts, one line per rule, pass through the driver.
    """
    df.createOrReplaceTempView(view)
    compiled, errors = _compile(df.sparkSession, rules, view)
    counts = _run_isolated(df, compiled, view, errors)
    return _results(df, rules, view, counts, errors)


def run_sql_pack(
    df: DataFrame, rules: Sequence[SqlRule], view: str, keep: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The results of a pack and the failing rows of the rules that ran.

    The counts are taken first. So it is known which rules break while running, and the failing rows are those of
    the other rules; rules that no row breaks are not run again. ``keep`` writes the failing rows and reads them back; with it
    they are written first and counted there, and only if a rule breaks are the counts taken first.
    """
    df.createOrReplaceTempView(view)
    compiled, errors = _compile(df.sparkSession, rules, view)
    counts, written = None, None
    if keep and compiled and len({r.rule_id for r in rules}) == len(rules):
        try:
            written = keep(_failed_rows(df, compiled, view))
            counts = {r["rule_id"]: r["n"] for r in written.groupBy("rule_id").agg(F.expr("count(*) AS n")).collect()} | {None: df.count()}
        except PySparkException:
            counts = None
    if counts is None:
        counts, written = _run_isolated(df, compiled, view, errors), None
    failing = [r for r in compiled if counts.get(r.rule_id)]
    failed = _failed_rows(df, failing, view)
    if written is not None and failing:
        failed = written.select(*map(name, failed.columns))
    elif keep:
        failed = keep(failed)
    return _results(df, rules, view, counts, errors), failed


def _results(df, rules, view, counts, errors) -> DataFrame:
    total = counts[None]
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("table_name", "rule_id", "dimension", "severity",
                                                    "description", "recommendation")]
        + [T.StructField(n, T.LongType()) for n in ("total_count", "failed_count")]
        + [T.StructField(n, T.StringType()) for n in ("status", "error_message")]
    )
    rows = []
    for r in rules:
        failed = total if r.rule_id in errors else counts.get(r.rule_id, 0)
        status = "error" if r.rule_id in errors else ("failed" if failed else "passed")
        rows.append((view, r.rule_id, r.dimension, r.severity, r.description, r.recommendation, total,
                     failed, status, errors.get(r.rule_id, "")))
    return finish_results(df.sparkSession.createDataFrame(rows, schema))


def _compile(spark: SparkSession, rules: Sequence[SqlRule], view: str) -> tuple[list[SqlRule], dict[str, str]]:
    """The rules that compile, as conditions on single rows where they are such, and the messages of the others."""
    compiled: list[SqlRule] = []
    errors: dict[str, str] = {}
    for rule in rules:
        try:
            spark.sql(rule.sql(view))
            compiled.append(lifted(spark, rule, view))
        except PySparkException as problem:
            errors[rule.rule_id] = str(problem)
    return compiled, errors


def _run_isolated(df: DataFrame, rules: Sequence[SqlRule], view: str, errors: dict[str, str]) -> dict[str | None, int]:
    """Failing rows by rule, all rows under None; rules that break are added to ``errors``.

    One job counts everything. If it breaks, conditions on single rows part from other SELECTs, which may shuffle the table,
    and either are halved until those that break stand alone: about 2 log2(n) jobs for each of them, not one for every rule.
    Shuffle files go with each job, broken ones included.
    """
    def run(part: Sequence[SqlRule]) -> dict[str | None, int]:
        with shuffles_dropped(df.sparkSession):
            return {r["rule_id"]: r["n"] for r in union_all([_total(df), *_counted(df, part, view)]).collect()}

    def isolate(part: Sequence[SqlRule]) -> dict[str | None, int]:
        try:
            return run(part)
        except PySparkException as problem:
            if not part:
                raise
            if len(part) == 1:
                errors[part[0].rule_id] = str(problem)
                return run([])
            middle = len(part) // 2
            first, second = [r for r in part if r.where], [r for r in part if not r.where]
            if not first or not second:
                first, second = part[:middle], part[middle:]
            return isolate(first) | isolate(second)

    return isolate(list(rules))


def _total(df: DataFrame) -> DataFrame:
    return df.agg(F.expr("count(*) AS n")).selectExpr("CAST(NULL AS STRING) AS rule_id", "n")


def _counted(df: DataFrame, rules: Sequence[SqlRule], view: str) -> list[DataFrame]:
    """Count queries of compiled rules: one for all conditions on single rows, one for every other SELECT."""
    spark = df.sparkSession
    shared = [r for r in rules if r.where]
    frames = []
    for rule in rules:
        if not rule.where:
            # The digest has Spark evaluate the SELECT list, which a count alone would leave out; types without a hash go as JSON.
            found = spark.sql(rule.sql(view))
            hashed = "to_json(struct(*))" if re.search(r"map<|variant", found.schema.simpleString()) else "*"
            counted = found.agg(F.expr("count(*) AS n"), F.expr(f"bit_xor(xxhash64({hashed})) AS __read"))
            frames.append(counted.selectExpr(f"{literal(rule.rule_id)} AS rule_id", "if(__read IS NULL, 0L, n) AS n"))
    if shared:
        counted = df.agg(*[F.expr(f"count_if({r.where}) AS f{i}") for i, r in enumerate(shared)])
        lines = ", ".join(f"named_struct('rule_id', {literal(r.rule_id)}, 'n', f{i})" for i, r in enumerate(shared))
        frames.append(counted.selectExpr(f"inline(array({lines}))"))
    return frames


def lifted(spark: SparkSession, rule: SqlRule, view: str) -> SqlRule:
    """A rule whose SELECT takes columns of the view under one condition, as a rule that can share the scan.

    The condition is what follows the only WHERE. It is taken only if Spark finds that the rule so written
    means the same as its own text; all other rules stay as they are.
    """
    found = None if rule.where else _ROW_LOCAL.fullmatch(rule.query)
    if not found:
        return rule
    whole = spark.table(view)
    columns = whole.columns if found["columns"] == "*" else [c.strip(" \n\t`") for c in found["columns"].split(",")]
    if not set(columns) <= set(whole.columns):
        return rule
    try:
        same = whole.where(found["where"]).select(*map(name, columns)).sameSemantics(spark.sql(rule.query))
    except PySparkException:
        return rule
    return replace(rule, columns=tuple(columns), where=found["where"], query="") if same else rule


def sql_failed_rows(df: DataFrame, rules: Sequence[SqlRule], view: str) -> DataFrame:
    """The failing rows of all rules with the rule's facts in front; absent columns are null.

    Conditions on single rows share one scan: each row is exploded once per rule that it breaks. A rule that does
    not compile has no failing rows here. Nothing is run, so a rule that breaks while running ends the query;
    ``run_sql_pack`` leaves such rules out.
    """
    df.createOrReplaceTempView(view)
    return _failed_rows(df, _compile(df.sparkSession, rules, view)[0], view)


def _failed_rows(df: DataFrame, rules: Sequence[SqlRule], view: str) -> DataFrame:
    spark = df.sparkSession
    shared = [r for r in rules if r.where]
    frames = []
    if shared:
        wanted = list(dict.fromkeys(c for r in shared for c in r.columns))
        hits = spread_rules(df, wanted, [r.where for r in shared])
        shown = []
        for c in wanted:
            reporting = ", ".join(str(i) for i, r in enumerate(shared) if c in r.columns)
            shown.append(f"CASE WHEN __rule IN ({reporting}) THEN {name(c)} END AS {name(c)}")
        facts = f"element_at(array({', '.join(map(_facts, shared))}), __rule + 1) AS __hit"
        frames.append(hits.selectExpr(facts, *shown).selectExpr("__hit.*", *map(name, wanted)))
    for r in rules:
        if not r.where:
            frames.append(spark.sql(r.sql(view)).selectExpr(f"inline(array({_facts(r)}))", "*"))
    if not frames:
        return df.where("false").selectExpr(*[f"CAST(NULL AS STRING) AS {n}" for n in ("rule_id", "severity", "dimension", "issue_type")], "*")
    return union_all(frames, ragged=True)


def _facts(rule: SqlRule) -> str:
    facts = {"rule_id": rule.rule_id, "severity": rule.severity, "dimension": rule.dimension,
             "issue_type": rule.description}
    return f"named_struct({', '.join(f'{literal(k)}, {literal(v)}' for k, v in facts.items())})"
