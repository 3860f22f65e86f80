"""Exact deduplication: group by a 128-bit content hash, compare bytes inside groups, keep the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import WHITE, Query, body, col, packed, stored, table


_ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def exact_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
    winners: bool = False,
) -> DataFrame:
    """All rows of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical after replacing each run of ASCII white space by one space.

    1. The 128-bit hashes of the texts are counted; only hashes that occur more than once go on.
    2. The texts behind those are grouped by their bytes, so texts that merely share a hash fall into different
       classes. The heavy hashes of the join before can be split, as the grouping shuffles anew, and copies meet in the map-side combine: each task sends a class once, however hot.
    3. The verdict of a class returns to its rows by (hash, SHA-256). Should two different texts share both,
       the job fails rather than merging them.

    ``carry`` lists the columns of the input to return, all if not given; ``winners`` returns only rows that stay.

    Null texts count as empty, and empty texts are equal to each other. Rows with a null id never win against
    rows with an id; ``keep_id`` is null if a class has only null ids, and one of its rows stays. Of rows
    that repeat text and id, one stays. An empty table gives an empty result. Columns of the input that clash
    with the result columns are left out in favour of these.
    """
    normal = F.regexp_replace(body(text_col), WHITE, " ")
    hashed = docs.select(col(id_col).alias("id"), normal.alias("t")).withColumn("h", F.unhex(F.md5("t")))
    repeated = hashed.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    classes = (
        hashed.join(repeated, "h", "left_semi")
        .groupBy("t")
        .agg(F.min("id").alias("least"), F.count("*").alias("n"))
        .select(F.unhex(F.md5("t")).alias("h"), F.unhex(F.sha2("t", 256)).alias("s"), "least", "n")
        .groupBy("h", "s")
        .agg(F.min("least").alias("least"), F.max("n").alias("n"), F.count("*").alias("texts"))
        .select("h", "s", "least", F.when(F.col("texts") == 1, F.col("n")).otherwise(
            F.raise_error(F.lit("two different texts share both content hashes"))).alias("n"))
    )
    kept_columns = [c for c in carry or docs.columns if c.lower() not in _ADDED]
    rows = docs.select(
        F.struct(*[col(c).alias(c) for c in kept_columns]).alias("row"), col(id_col).alias("id"), normal.alias("t"),
    ).select("row", "id", F.unhex(F.md5("t")).alias("h"), F.unhex(F.sha2("t", 256)).alias("s"))
    size = F.coalesce("n", F.lit(1).cast("long"))
    joined = rows.join(classes, ["h", "s"], "left").select(
        "row", "id", "s", F.when(size == 1, F.col("id")).otherwise(F.col("least")).alias("keep_id"), size.alias("group_size"))
    least = F.col("keep_id").eqNullSafe(F.col("id"))
    if winners:
        joined = joined.filter(least)
    # Only rows that repeat both text and id meet in this window.
    order = F.when(F.col("group_size") > 1, F.xxhash64(F.to_json("row")))
    place = F.row_number().over(Window.partitionBy("s", "id").orderBy(order))
    marked = joined.withColumn("kept", least & (place == 1))
    if winners:
        marked = marked.filter("kept")
    return marked.select("row.*", "keep_id", "group_size", "kept", F.lower(F.hex("s")).alias("text_sha256"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``.

    Only rows whose hash occurs more than once are classed; the others stay without being shuffled. The rows are written
    once with a number each, and so are the repeated hashes and the numbers of the rows that go: Spark sees the true sizes
    of these lists and broadcasts a small one, or else joins by shuffle.
    """
    whole = packed(docs, **{"id": id_col, "text": text_col})
    h = F.unhex(F.md5(F.regexp_replace(F.coalesce("text", F.lit("")), WHITE, " ")))
    rows = stored(whole.select("row", "id", F.monotonically_increasing_id().alias("no"), h.alias("h")), "numbered")
    repeated = stored(rows.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "repeated")
    few = rows.join(repeated, "h", "left_semi").select("no", "id", F.col("row").getField(text_col).alias("text"))
    gone = stored(exact_classes(few, "id", "text", ["no"]).filter("not kept").select("no"), "copies")
    return rows.join(gone, "no", "left_anti").select("row.*")


def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return exact_classes(docs, carry=["doc_id"]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM normal"""

QUERY = Query("op7_exact_dedup", op7, SQL)
