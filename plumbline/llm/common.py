"""Shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.session import fresh_path

#: Fixed pattern: the white space of words in all operators.
WHITE = r"[\x20\x09-\x0D]+"
#: Bytes of a batch of texts between the JVM and Python; a longer text is a batch of its own.
BATCH_BYTES = 8 << 20


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def col(name: str) -> Column:
    """A top-level column, whatever signs its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, **needed: str) -> DataFrame:
    """The needed columns under the operator's own names, and the whole row as ``row``.

    Columns of the input can thus have any name without clashing with those that an operator adds.
    """
    whole = F.struct(*[col(c).alias(c) for c in df.columns]).alias("row")
    return df.select(whole, *[col(name).alias(own) for own, name in needed.items()])


def unpacked(df: DataFrame, *extra: str) -> DataFrame:
    """The rows that ``packed`` wrapped, with further columns behind."""
    return df.select("row.*", *extra)


def body(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(col(name), F.lit(""))


def words_in(text: Column) -> Column:
    """Number of words of a text: the places where a word begins."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back, which cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, purpose: str, key: str, n: int, dealt: bool = False) -> DataFrame:
    """As ``stored``, in n buckets by a column, so that groups and joins by it read the table without a shuffle.

    Rows are dealt to the buckets first unless tasks hold whole keys (``dealt``). Shuffle files of the write go with its end, as
    nothing else can read them. The catalog's entry is dropped at once; the files stay.
    """
    spark, path, own = df.sparkSession, fresh_path(df.sparkSession, purpose), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    name = f"{purpose.replace('-', '_')}_{uuid.uuid4().hex}"
    before = spark.conf.get(own)
    spark.conf.set(own, "true")
    try:
        (df if dealt else df.repartition(n, key)).write.bucketBy(n, key).option("path", path).option("compression", "zstd").saveAsTable(name)
    finally:
        spark.conf.set(own, before)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def in_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], out: StructType | str,
) -> DataFrame:
    """``mapInArrow`` by batches of bounded bytes, of which a task holds several copies in the JVM and in Python."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, out)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def remainder(name: str, divisor: int) -> Column:
    """CRC-32 of an id as text, modulo a number; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col(name).cast("string"), F.lit("")).cast("binary")) % divisor
