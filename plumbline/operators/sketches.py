"""Column profiles kept per part of a table, such as a day, and merged: a new day reads its own rows only.

A line holds exact counts of rows and missing values, a sketch of the distinct values and one of the frequent values of
a column within a part. Sketches of any parts merge into that of their union, so a profile of a
table, a month or a source follows from lines alone. Their sizes do not depend on the number of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.numbers import percentage_sql
from plumbline.functions.text import literal, name
from plumbline.operators.profiling import value_counts
from plumbline.sources.tables import null_nans

#: Logarithm of the buckets of a sketch of distinct values (16 KB), and values that a sketch of frequent ones follows.
LOG_BUCKETS, TRACKED = 14, 1536
#: Values of more characters take part by their digest, which bounds the sketch of frequent values to about a megabyte.
LONGEST = 256
#: The share of an estimated distinct count that the true one differs from it by at most: three standard errors of a merged sketch.
DISTINCT_ERROR = 3 * 1.04 / math.sqrt(2 ** LOG_BUCKETS)
#: The share of the rows that a value's count is over-estimated by at most, with slots for 4 values of every 3 followed.
FREQUENT_ERROR = 3.5 / 2 ** math.ceil(math.log2(TRACKED / 0.75))


def _shown(value: str) -> str:
    return f"CASE WHEN length({value}) > {LONGEST} THEN concat('sha256:', sha2({value}, 256)) ELSE {value} END"


def sketch(df: DataFrame, part: str) -> DataFrame:
    """One line per part and column: ``part``, ``position``, ``column_name``, ``dtype``, counts and the two sketches.

    ``part`` is an SQL expression; null is a part of its own. NaN counts as missing. Tasks combine their rows into one line
    per part and column before the shuffle, so a part or a value with most of the rows is no burden.
    """
    fields = df.schema.fields
    pairs = ", ".join(f"{i}, {literal(f.name)}, {literal(f.dataType.simpleString())}, CAST({name(f.name)} AS STRING)" for i, f in enumerate(fields))
    parted = null_nans(df).withColumn("__part", F.expr(f"CAST({part} AS STRING)"))
    lines = parted.selectExpr("__part AS part", f"stack({len(fields)}, {pairs}) AS (position, column_name, dtype, value)")
    return lines.groupBy("part", "position", "column_name", "dtype").agg(
        F.expr("count(*) AS row_count"), F.expr("count_if(value IS NULL) AS missing_count"),
        F.expr(f"hll_sketch_agg(value, {LOG_BUCKETS}) AS distinct_values"),
        F.expr(f"approx_top_k_accumulate({_shown('value')}, {TRACKED}) FILTER (WHERE value IS NOT NULL) AS frequent_values"))


def keep(sketches: DataFrame, path: str) -> str:
    """Write the lines to a folder per part. Parts that are there already are replaced, all others stay as they are."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    return path


def kept(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all parts, the part as text."""
    return spark.read.option("basePath", path).schema(
        "position INT, column_name STRING, dtype STRING, row_count BIGINT, missing_count BIGINT, distinct_values BINARY, "
        "frequent_values STRUCT<sketch: BINARY, maxItemsTracked: INT, itemDataType: STRING, itemDataTypeDDL: STRING>, part STRING").parquet(path)


def merged_profile(sketches: DataFrame, table_name: str, top: int = 5) -> DataFrame:
    """The profile of the union of all given parts, in the order of the columns.

    ``unique_count`` is an estimate, off by at most ``DISTINCT_ERROR`` of it with a probability of 99.7 %; the rows of a top
    value are never too few, and too many by ``top_values_error`` at most. Up to ``TRACKED`` distinct values they are exact.
    """
    merged = sketches.groupBy("position", "column_name", "dtype").agg(
        F.expr("sum(row_count) AS row_count"), F.expr("sum(missing_count) AS missing_count"),
        F.expr("hll_sketch_estimate(hll_union_agg(distinct_values)) AS unique_count"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent_values, {TRACKED}), {top}) AS found"))
    return merged.orderBy("position").selectExpr(
        f"{literal(table_name)} AS table_name", "column_name", "row_count", "missing_count",
        f"{percentage_sql('missing_count', 'row_count')} AS missing_pct", "unique_count", "dtype",
        "transform(found, i -> struct(i.item AS value, i.count AS rows)) AS top_values",
        f"CAST(floor((row_count - missing_count) * {FREQUENT_ERROR!r}D) AS BIGINT) AS top_values_error")


def audited(profile: DataFrame, df: DataFrame) -> DataFrame:
    """A merged profile against a scan of the whole table: exact counts by column, and whether the estimates keep their bounds.

    ``top_in_bound`` says that the count of each top value is right within ``top_values_error`` and that no other
    value occurs more often than the last of them is said to.
    """
    positions = df.sparkSession.createDataFrame(list(enumerate(df.columns)), "position INT, column_name STRING")
    exact = value_counts(df).join(positions, "position").selectExpr("column_name", f"{_shown('value')} AS value", "rows")
    shown = profile.selectExpr(
        "column_name", "inline_outer(top_values)", "top_values_error", "array_min(top_values.rows) AS least")
    values = exact.join(profile.select("column_name", "top_values_error", F.expr("array_min(top_values.rows) AS least")), "column_name").join(
        shown.where("value IS NOT NULL").selectExpr("column_name", "value", "rows AS said"), ["column_name", "value"], "left")
    wrong = "said IS NULL AND value IS NOT NULL AND rows > least OR said < rows OR said > rows + top_values_error"
    facts = values.groupBy("column_name").agg(
        F.expr("sum(rows) AS exact_rows"), F.expr("coalesce(sum(CASE WHEN value IS NULL THEN rows END), 0L) AS exact_missing"),
        F.expr("count(value) AS exact_unique"), F.expr(f"count_if({wrong}) AS wrong"))
    return profile.join(facts, "column_name").selectExpr(
        "table_name", "column_name", "exact_rows AS row_count", "exact_missing AS missing_count", "exact_unique AS unique_count",
        "row_count = exact_rows AND missing_count = exact_missing AS counts_equal",
        f"abs(unique_count - exact_unique) <= greatest(unique_count, exact_unique) * {DISTINCT_ERROR!r}D AS unique_in_bound", "wrong = 0 AS top_in_bound")
