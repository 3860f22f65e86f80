"""Audit of filters in every order: cells of failing filters are folded over all orders with higher-order functions."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import Query, body, col, table

#: Production parameters: fewest words, per cent of words that must be distinct, most capitals per hundred code points.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
#: Fixed value: signs of which a text may hold none.
SIGNS = r"[#$%&*|]"
FILTERS = "ABCDE"
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails: too short, too repetitive, too many capitals, a sign."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    length, capitals = F.length(text), F.length(F.regexp_replace(text, "[^A-Z]+", ""))

    def bit(fails: Column, value: int) -> Column:
        return F.when(fails, F.lit(value)).otherwise(F.lit(0))

    n, distinct = F.size(words), F.size(F.array_distinct(words))
    return (
        bit(n < LEAST_WORDS, 1)
        + bit(distinct * 100 < n * LEAST_DISTINCT, 2)
        + bit(capitals.cast("long") * 100 > length.cast("long") * MOST_CAPITALS, 4)
        + bit(text.rlike(SIGNS), 8)
    )


def cells(docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Numbers of documents by ``part``, ``mask`` of failed filters, ``good`` and ``toxic``.

    Only ids, hashes and masks are shuffled. Texts are told apart by SHA-256. Documents of one text fall into few groups
    (parts and labels), each with its least id, before any exchange by text, so a text with a third of all rows is one row
    from each task; whoever has the least id of all the groups of a text passes E.
    """
    marks = labels.select(col("doc_id").alias("id"), col("quality").alias("q"), col("toxic").alias("x")).filter("id is not null")
    marks = marks.groupBy("id").agg(
        F.coalesce(F.max((F.col("q") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("x") == 1).cast("int")), F.lit(0)).alias("toxic"))
    text = body(text_col)
    rows = docs.select(
        col(id_col).alias("id"), F.coalesce(col(part_col).cast("string"), F.lit("")).alias("part"),
        own_failures(text).alias("own"), F.unhex(F.sha2(text, 256)).alias("h"))
    marked = rows.join(marks, "id", "left").select(
        "id", "part", "own", "h", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    keys = ["part", "own", "good", "toxic"]
    # The join leaves rows of one id together, so that counting them first needs no exchange.
    by_id = marked.groupBy("id", "h", *keys).agg(F.count("*").alias("n"))
    groups = by_id.groupBy("h", *keys).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n"))).alias("nameless"),
        F.min("id").alias("least"), F.min_by("n", "id").alias("n_least"))
    of_texts = groups.groupBy("h").agg(F.min("least").alias("first"), F.count("*").alias("groups"))
    # Most texts form one group and need no partner; the groups of the others are joined to the least id of the text.
    joined = groups.join(of_texts, "h")
    passing = F.coalesce("nameless", F.lit(0)) + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    split = joined.select(*keys, F.explode(F.array(
        F.struct(F.col("own").alias("mask"), passing.alias("n")),
        F.struct((F.col("own") + 16).alias("mask"), (F.col("n") - passing).alias("n")))).alias("c"))
    return split.filter("c.n > 0").groupBy("part", F.col("c.mask").alias("mask"), "good", "toxic").agg(F.sum("c.n").alias("n"))


def folded(cell: DataFrame) -> DataFrame:
    """One row for each part, order of all filters and step, from the cells of ``cells``.

    The orders are one array literal of 120 strings. A cell folds along each with ``aggregate``, which carries whether its
    documents are still there, into 600 structs weighted by its count; these are summed place by place.
    """
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    zero = F.lit(0).cast("long")
    bits = {f: 1 << i for i, f in enumerate(FILTERS)}
    bit_of = F.create_map(*[F.lit(x) for pair in bits.items() for x in pair])
    kind = f"struct<alive:boolean,steps:array<struct<filter_order:string,step:int,filter:string,{','.join(c + ':bigint' for c in _COUNTS)}>>>"

    def along(order: Column) -> Column:
        def step(state: Column, k: Column) -> Column:
            letter = F.substring(order, k, F.lit(1))
            fails = F.col("mask").bitwiseAND(bit_of[letter]) != 0
            alive = state["alive"]
            gone = alive & fails

            def count(condition: Column) -> Column:
                return F.when(condition, F.col("n")).otherwise(zero)

            entry = F.struct(
                order.alias("filter_order"), k.alias("step"), letter.alias("filter"), count(alive & ~fails).alias("kept"),
                count(gone).alias("removed"), count(~alive & fails).alias("redundant"),
                count(F.col("mask") == bit_of[letter]).alias("unique_fails"), count(gone & (F.col("good") == 1)).alias("good_lost"),
                count(gone & (F.col("toxic") == 1)).alias("toxic_lost"))
            return F.struct((alive & ~fails).alias("alive"), F.concat(state["steps"], F.array(entry)).alias("steps")).cast(kind)

        start = F.struct(F.lit(True).alias("alive"), F.array().alias("steps")).cast(kind)
        return F.aggregate(F.array(*map(F.lit, range(1, len(FILTERS) + 1))), start, step, lambda s: s["steps"])

    places = cell.select("part", F.inline(F.flatten(F.transform(orders, along))))
    sums = places.groupBy("part", "filter_order", "step", "filter").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    values = sums.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return sums.join(values, ["part", "filter"]).select("part", "filter_order", "step", *_COUNTS, "shapley")


def audited(docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What each filter keeps and removes in each order, by part; see ``cells`` for the documents and ``folded`` for the orders.

    A null text counts as empty, a null part as the empty text. A row with a null id has no smaller id, is no smaller id and
    has no label; rows that repeat id and text all pass or all fail E. Of several labels of an id one with the value 1 is
    enough; null labels and null ids of labels are left out. An empty table gives no row. Other columns are not read.
    """
    return folded(cells(docs, labels, part_col, id_col, text_col))


def op13(spark: SparkSession, folder: str) -> DataFrame:
    return audited(table(spark, folder, "documents").select("doc_id", "text", "lang"), table(spark, folder, "labels"))


SQL = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
failing AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < {LEAST_WORDS} THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < {LEAST_DISTINCT} * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '{SIGNS}') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM docs),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
  FROM failing LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, s::INT AS step, filter_order[s] AS f, filter_order[1:s - 1] AS before FROM orders, range(1, 6) r(s)),
sums AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT gone AND NOT bad THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT gone AND bad THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone AND bad THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT gone AND bad AND good = 1 THEN n ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT gone AND bad AND toxic = 1 THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM (SELECT *, contains(fails, f) AS bad, fails <> '' AND before <> '' AND regexp_matches(fails, '[' || before || '_]') AS gone
        FROM cells, steps)
  GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley
FROM sums"""

QUERY = Query("op13_filter_audit", op13, SQL)
