"""Column profiles in the two report shapes.

Everything exact about a column follows from the counts of its values. Tasks count the values of some
ten thousand rows at a time in Arrow and combine these (column, value) lines before the shuffle, so a value shared
by a third of the rows costs one line per task, and no distinct set is gathered in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.numbers import percentage_sql
from plumbline.functions.text import is_blank, literal, name
from plumbline.sources.tables import null_nans

MISSING_TEXT = "nan"
#: Bytes of a batch between the JVM and Python, and of rows whose values a task counts at a time.
BATCH_BYTES = 8 << 20
HELD_BYTES = 32 << 20


def value_counts(df: DataFrame) -> DataFrame:
    """Every column's values as text with their number of rows, the column given by its position.

    Null is a value of its own; NaN counts as null.
    """
    lines = _texts(df).mapInArrow(_counted, "position INT, value STRING, rows BIGINT")
    return lines.groupBy("position", "value").agg(F.expr("sum(rows) AS rows"))


def _texts(df: DataFrame) -> DataFrame:
    """All columns as text, NaN as null, in Arrow batches of bounded bytes."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return null_nans(df).selectExpr(*[f"CAST({name(c)} AS STRING) AS c{i}" for i, c in enumerate(df.columns)])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The values of each column in about ``HELD_BYTES`` of rows, each once with its number of rows."""
    held: list[pa.RecordBatch] = []

    def counted() -> Iterator[pa.RecordBatch]:
        for i, column in enumerate(pa.Table.from_batches(held).columns):
            values, rows = column.value_counts().flatten()
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(i, pa.int32()), len(values)), values, rows], ["position", "value", "rows"])

    size = 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.nbytes
        if size >= HELD_BYTES:
            yield from counted()
            held, size = [], 0
    if held:
        yield from counted()


def _by_position(values: list[str]) -> str:
    """A text of each column, chosen by its position."""
    return f"element_at(array({', '.join(map(literal, values))}), position + 1)"


def top_values(df: DataFrame, n: int = 5) -> DataFrame:
    """The most frequent values per column; ties by value."""
    return _top(value_counts(df), n).selectExpr(f"{_by_position(df.columns)} AS column_name", "shown AS value", "rows", "place")


def _top(counts: DataFrame, n: int) -> DataFrame:
    """Tasks keep only ``n`` candidates per column before the shuffle."""
    order = Window.partitionBy("position").orderBy(F.desc("rows"), "shown")
    shown = counts.selectExpr("position", f"coalesce(value, {literal(MISSING_TEXT)}) AS shown", "rows")
    return shown.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def _facts(counts: DataFrame, *more: str) -> DataFrame:
    """Rows, missing rows and distinct values per column."""
    return counts.groupBy("position").agg(
        F.expr("sum(rows) AS row_count"),
        F.expr("coalesce(sum(CASE WHEN value IS NULL THEN rows END), 0L) AS missing_count"),
        F.expr("count(value) AS unique_count"),
        *map(F.expr, more),
    )


def _columns(df: DataFrame) -> DataFrame:
    """The columns of the table; joined from the left, they keep a line for each column of an empty table."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position INT, column_name STRING, dtype STRING")


def profile(df: DataFrame, table_name: str, top: int = 5) -> DataFrame:
    """Per column: rows, missing, distinct, their percentages, type and most frequent values."""
    counts = value_counts(df)
    listed = "transform(sort_array(collect_list(struct(place, shown, rows))), i -> struct(i.shown AS value, i.rows AS rows))"
    best = _top(counts, top).groupBy("position").agg(F.expr(f"{listed} AS top_values"))
    found = _columns(df).join(_facts(counts), "position", "left").join(best, "position", "left")
    zeros = {"row_count": 0, "missing_count": 0, "unique_count": 0}
    return found.fillna(zeros).orderBy("position").selectExpr(
        f"{literal(table_name)} AS table_name", "column_name", "row_count", "missing_count",
        f"{percentage_sql('missing_count', 'row_count')} AS missing_pct", "unique_count",
        f"{percentage_sql('unique_count', 'row_count')} AS unique_pct", "dtype",
        "coalesce(top_values, CAST(array() AS ARRAY<STRUCT<value: STRING, rows: BIGINT>>)) AS top_values",
    )


def top_values_text(profiled: DataFrame) -> DataFrame:
    """The profile with its most frequent values as one text, for flat files."""
    text = F.array_join(
        F.transform("top_values", lambda i: F.concat(i["value"], F.lit(": "), i["rows"].cast("string"))), ", "
    )
    return profiled.withColumn("top_values", text)


def approximate_profile(df: DataFrame, table_name: str, rsd: float = 0.02) -> DataFrame:
    """Missing and estimated distinct counts in a single scan without a shuffle of values."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"m{i}"), F.approx_count_distinct(c, rsd).alias(f"d{i}")]
    lines = [
        F.struct(F.lit(c).alias("column_name"), F.col("n").alias("row_count"), F.col(f"m{i}").alias("missing_count"),
                 F.col(f"d{i}").alias("approx_unique_count"))
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*aggs).select(F.lit(table_name).alias("table_name"), F.inline(F.array(*lines)))


def onboarding_profile(df: DataFrame, dataset_name: str, key: str, samples: int = 5) -> DataFrame:
    """Per column: type, missing, blank, distinct and the first values in key order.

    ``blank_count`` includes missing values, so ``missing_or_blank_count`` counts those twice; the
    report has always been read that way. ``missing_or_blank_distinct`` counts each row once.
    """
    facts = _facts(
        value_counts(df), f"coalesce(sum(CASE WHEN {is_blank('value')} THEN rows END), 0L) AS blank_count"
    )
    found = _columns(df).join(facts, "position", "left").join(sample_values(df, key, samples), "column_name", "left")
    zeros = {"row_count": 0, "missing_count": 0, "blank_count": 0, "unique_count": 0, "sample_values": ""}
    both = "(missing_count + blank_count)"
    return found.fillna(zeros).orderBy("position").selectExpr(
        f"{literal(dataset_name)} AS dataset_name", "column_name", "dtype", "row_count AS total_rows", "missing_count",
        "blank_count", f"{both} AS missing_or_blank_count",
        f"{percentage_sql(both, 'row_count')} AS missing_or_blank_pct",
        "blank_count AS missing_or_blank_distinct", "unique_count AS distinct_count", "sample_values",
    )


def sample_values(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first non-null values of every column, joined by a bar; a column without values has no line.

    Rows are ordered by the key, missing keys last, and then by all columns. One scan serves all columns, however sparse:
    each task keeps the first ``n`` values of every column while its batches pass, and only those are shuffled.
    """
    columns, at = df.columns, df.columns.index(key)
    texts = _texts(df)

    def place(row: list[str | None]) -> tuple:
        return row[at] is None, row[at] or "", *((v is not None, v or "") for v in row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in columns]
        for b in batches:
            if all(len(found) == n for found in best):
                # Rows behind the last kept key of every column take no place; missing keys are last.
                last = max((row[at] is None, row[at] or "") for found in best for _, row in found)
                b = b if last[0] else b.filter(pc.less_equal(b[f"c{at}"], last[1]))
            # Arrow puts nulls last; a column of flags before each column puts them first.
            parts = {"last": pc.is_null(b[f"c{at}"]), "key": b[f"c{at}"]}
            for i in range(len(columns)):
                parts |= {f"v{i}": pc.is_valid(b[f"c{i}"]), f"c{i}": b[f"c{i}"]}
            order = pc.sort_indices(pa.table(parts), sort_keys=[(p, "ascending") for p in parts]).to_numpy()
            for i, found in enumerate(best):
                first = order[np.flatnonzero(np.asarray(parts[f"v{i}"])[order])[:n]]
                rows = list(zip(*[b[f"c{j}"].take(pa.array(first)).to_pylist() for j in range(len(columns))], strict=True))
                best[i] = sorted([*found, *((place(r), list(r)) for r in rows)], key=lambda x: x[0])[:n]
        kept = [(i, row[i], row) for i, found in enumerate(best) for _, row in found]
        positions, values, rows = zip(*kept, strict=True) if kept else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(positions, pa.int32()), pa.array(values, pa.string()), pa.array(rows, pa.list_(pa.string()))], ["position", "value", "row"])

    first = texts.mapInArrow(run, "position INT, value STRING, row ARRAY<STRING>")
    order = Window.partitionBy("position").orderBy(F.expr(f"row[{at}] IS NULL"), F.expr(f"row[{at}]"), "row")
    placed = first.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
    listed = placed.groupBy("position").agg(F.expr("array_join(sort_array(collect_list(struct(place, value))).value, ' | ') AS sample_values"))
    return listed.selectExpr(f"{_by_position(columns)} AS column_name", "sample_values")
