"""Sinks: report files, curated output, marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plumbline.functions.text import name
from plumbline.session import shuffles_dropped


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats without nesting."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.selectExpr(*[
        f"to_json({name(f.name)}) AS {name(f.name)}" if isinstance(f.dataType, nested) else name(f.name)
        for f in df.schema.fields
    ])


def write_report(df: DataFrame, path: str, fmt: str = "parquet", one_file: bool = False) -> str:
    """Overwrite a report, by default with as many files as it has tasks.

    ``one_file`` gathers it in one task after the report is computed; meant for aggregates, not for failing rows. Other CSV
    reports are written with gzip, as failing rows take several times the space of their table as plain text.
    """
    shown = flat(df) if fmt == "csv" else df
    writer = (shown.repartition(1) if one_file else shown).write.mode("overwrite").format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    if fmt == "csv":
        # Failing values are shown as they are, blanks included; readers take an empty one for a missing one.
        writer = writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        writer = writer.option("compression", "none" if one_file else "gzip")
    with shuffles_dropped(df.sparkSession):
        writer.save(path)
    return path


def write_curated(reviewed: DataFrame, path: str) -> str:
    """Accepted and quarantined records in one pass, one folder per status.

    Tasks keep a file of each status open, so that records need not be sorted by it, which would spill them to disk.
    """
    spark, own = reviewed.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(own)
    spark.conf.set(own, "2")
    try:
        with shuffles_dropped(spark):
            reviewed.write.mode("overwrite").option("compression", "zstd").partitionBy("curation_status").parquet(path)
    finally:
        spark.conf.set(own, before)
    return path


def write_mart(df: DataFrame, table: str, path: str | None = None) -> None:
    """A mart as a catalogue table; with a path it is external to the warehouse."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def read_mart(spark, table: str) -> DataFrame:
    return spark.table(table)
