"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Query, col, packed, table, words_in

#: Production parameters.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BLOCK_WORDS = 16
SEED = 42


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: the share of all words that a source should have.

    Sources in order of code points, null last, get the weights in turn. Targets stop at ``most`` times the
    source's size and the excess is shared by weight among the others, until none is above: with sources in
    order of size by weight, those are capped whose bound lies below the level that the rest would get. The
    sums are of whole numbers, so their order doesn't matter. One row per source is ordered in one task.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (turn % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    ranked = ranked.withColumn("ratio", F.col("cap").cast("double") / F.col("weight").cast("double"))
    below = Window.orderBy("ratio").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy(F.lit(0))
    summed = ranked.select(
        "*", F.sum("cap").over(below).alias("caps"), F.sum("weight").over(below).alias("weights"),
        F.sum("source_size").over(everything).alias("total"), F.sum("weight").over(everything).alias("all_weights"))
    # A source is at its cap if all of that ratio and below can be: what is left gives the others no less by weight.
    capped = (F.col("weights") == F.col("all_weights")) & (F.col("caps") <= F.col("total")) | (
        (F.col("total") - F.col("caps")).cast("double")
        >= F.col("ratio") * (F.col("all_weights") - F.col("weights")).cast("double"))
    marked = summed.withColumn("capped", capped)
    left = F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(F.lit(0).cast("long"))).over(everything)
    open_weights = F.sum(F.when(F.col("capped"), F.lit(0).cast("long")).otherwise(F.col("weight"))).over(everything)
    level = left.cast("double") * F.col("weight").cast("double") / F.when(open_weights > 0, open_weights.cast("double"))
    return marked.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level).alias("target"))


def sainte_lague(parties: DataFrame, house: str, votes: str, seats: Column, tie: str) -> DataFrame:
    """``parties`` with ``quota``: the seats of each party of a house that the highest quotients votes / (2k + 1) win.

    With V votes, H seats and P parties, every party gets at least the rounded votes * (H - P/2) / V and at most
    the rounded votes * (H + P/2) / V seats. Only the quotients between those bounds are ranked, at most 2P in
    all, which gives the same seats as ranking all quotients. Ties go to the smaller ``tie`` column.
    """
    w = Window.partitionBy(house)
    v, h, p = F.sum(votes).over(w), seats.cast("double"), F.count("*").over(w).cast("double")
    bounds = parties.select(
        "*",
        F.when(v > 0, F.floor(F.col(votes) * F.greatest(h - p / 2, F.lit(0.0)) / v + 0.5)).otherwise(F.lit(0)).cast("long").alias("least_"),
        F.when(v > 0, F.floor(F.col(votes) * (h + p / 2) / v + 0.5)).otherwise(F.lit(0)).cast("long").alias("most_"),
        h.cast("long").alias("seats_"))
    # Rounding of the doubles can be off by one at an exact half: one seat more on either side is looked at.
    bounds = bounds.withColumn("least_", F.greatest(F.col("least_") - 1, F.lit(0).cast("long"))).withColumn(
        "most_", F.when(F.col(votes) > 0, F.col("most_") + 1).otherwise(F.lit(0).cast("long")))
    bounds = bounds.withColumn("left_", F.col("seats_") - F.sum("least_").over(w))
    tried = bounds.filter("most_ > least_").select(
        house, tie, "left_", votes, F.explode(F.sequence(F.col("least_"), F.col("most_") - 1)).alias("k_"))
    rank = F.row_number().over(Window.partitionBy(house).orderBy((F.col(votes) / (2 * F.col("k_") + 1)).desc(), tie, "k_"))
    won = tried.withColumn("rank_", rank).filter("rank_ <= left_").groupBy(house, tie).agg(F.count("*").alias("won_"))
    joined = bounds.join(won.select(F.col(house).alias("house_"), F.col(tie).alias("tie_"), "won_"),
                         F.col(house).eqNullSafe(F.col("house_")) & F.col(tie).eqNullSafe(F.col("tie_")), "left")
    quota = F.col("least_") + F.coalesce("won_", F.lit(0).cast("long"))
    return joined.withColumn("quota", quota).drop("least_", "most_", "seats_", "left_", "house_", "tie_", "won_")


def hash_number(*parts: Column) -> Column:
    """A number from 0 to 2^60 - 1 that depends on the parts as text."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def mixture(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, block: int = BLOCK_WORDS,
    seed: int = SEED, carry: list[str] | None = None,
) -> DataFrame:
    """The rows of ``docs`` with ``size``, ``source_size``, ``target`` and ``taken``, the words that the mix takes.

    1. Sources get whole numbers of equal blocks of ``block`` words by Sainte-Laguë over their targets.
    2. Rows are dealt by a seeded hash to shards, half the square root of the number of rows, so that the rows of a
       shard and the shards of a source both stay few. The source's blocks are apportioned to its shards by their
       sizes, again by Sainte-Laguë.
    3. In a shard of a source the rows stand in a seeded order as one circle of words. The shard's quota is
       taken as consecutive blocks from a seeded place on: whole rounds count for every row, the rest for the
       rows that it covers. A row is taken at most once more than the whole rounds, and never over ``most`` times.

    A source of a third of all rows spreads over a third of all (source, shard) groups. Null texts have size 0, null
    sources are one source, null ids are ids like others; rows without words take nothing. An empty table gives an
    empty result. ``carry`` lists the columns to return, all if not given; clashing ones give way to the results.
    """
    added = ("size", "source_size", "target", "taken")
    kept = [c for c in carry or docs.columns if c.lower() not in added]
    text = F.coalesce(col(text_col), F.lit(""))
    shards = max(1, math.ceil(math.sqrt(docs.count()) / 2))
    order = hash_number(F.lit(str(seed)), F.coalesce(col(id_col).cast("string"), F.lit("")), F.md5(text))
    rows = docs.select(
        F.struct(*[col(c).alias(c) for c in kept]).alias("row"), col(source_col).alias("source"),
        words_in(text).alias("size"), order.alias("order")).withColumns({
            "key": F.coalesce("source", F.lit("")), "none": F.col("source").isNull(), "shard": F.col("order") % shards})
    cells = rows.groupBy("source", "key", "none", "shard").agg(F.sum("size").alias("cell_size"))
    everyone = Window.partitionBy(F.lit(0))
    # One row per source; the number of a source is a key without nulls.
    sources = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, most).withColumns({
        "party": F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long"), "house": F.lit(0)})
    seats = F.round(F.sum("source_size").over(everyone) / F.lit(float(block)))
    quotas = sainte_lague(sources, "house", "target", seats, "party").select(
        F.coalesce("source", F.lit("")).alias("key"), F.col("source").isNull().alias("none"),
        "source_size", "target", "party", F.col("quota").alias("blocks"))
    votes = F.when(F.col("source_size") > 0, F.col("target") * F.col("cell_size") / F.col("source_size")).otherwise(F.lit(0.0))
    known = cells.join(quotas, ["key", "none"]).withColumn("votes", votes)
    dealt = sainte_lague(known, "party", "votes", F.col("blocks"), "shard")
    start = hash_number(F.lit(str(seed)), F.col("party").cast("string"), F.col("shard").cast("string"))
    dealt = dealt.withColumn("wanted", F.least(F.col("quota") * block, F.col("cell_size") * most))
    filled = F.col("cell_size") > 0
    none = F.lit(0).cast("long")
    cell = dealt.select(
        "key", "none", "shard", "source_size", "target", "cell_size",
        F.when(filled, F.expr("wanted div cell_size")).otherwise(none).alias("rounds"),
        F.when(filled, F.col("wanted") % F.col("cell_size")).otherwise(none).alias("rest"),
        F.when(filled, start % F.col("cell_size")).otherwise(none).alias("start"))
    here = Window.partitionBy("key", "none", "shard").orderBy("order", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    lined = rows.withColumn("after", F.sum("size").over(here))
    both = lined.join(cell, ["key", "none", "shard"])
    first, end = F.col("after") - F.col("size"), F.col("start") + F.col("rest")

    def overlap(begin: Column, stop: Column) -> Column:
        return F.greatest(F.least(F.col("after"), stop) - F.greatest(first, begin), none)

    taken = F.col("rounds") * F.col("size") + overlap(F.col("start"), end) + overlap(none, end - F.col("cell_size"))
    return both.select("row.*", "size", "source_size", "target", taken.alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """The mix as rows with the columns of ``docs``: each as many times as the mix takes it.

    A row taken k times and in part is there k or k + 1 times, by a seeded hash with the part as its probability, so
    that a source has the words of its target on average. Rows without words are not part of the mix.
    """
    whole = packed(docs, **{"id": id_col, "text": text_col, "source": source_col})
    draw = hash_number(F.lit(f"{seed}|part"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))))
    rows = mixture(whole.withColumn("draw", draw), "id", "text", "source", seed=seed, carry=["row", "draw"]).filter("taken > 0")
    more = (F.col("draw") / F.lit(float(1 << 60)) < F.col("taken") % F.col("size") / F.col("size")).cast("int")
    copies = F.expr("taken div size").cast("int") + more
    return rows.select("row", F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).select("row.*")


def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixture(docs, carry=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


_APPORTIONED = """
  SELECT *, greatest(floor(votes * greatest(seats - p / 2, 0) / nullif(v, 0) + 0.5)::BIGINT - 1, 0) AS least_,
         CASE WHEN votes > 0 THEN floor(votes * (seats + p / 2) / v + 0.5)::BIGINT + 1 ELSE 0 END AS most_
  FROM (SELECT *, sum(votes) OVER (PARTITION BY house) AS v, (count(*) OVER (PARTITION BY house))::DOUBLE AS p FROM {0})"""


def _apportion_sql(name: str, parties: str) -> str:
    return f"""
{name}_bounds AS (
  SELECT *, seats::BIGINT - sum(coalesce(least_, 0)) OVER (PARTITION BY house) AS left_ FROM ({_APPORTIONED.format(parties)})),
{name}_won AS (
  SELECT house, tie, count(*) AS won FROM (
    SELECT house, tie, left_, row_number() OVER (PARTITION BY house ORDER BY votes / (2 * k + 1) DESC, tie, k) AS rank
    FROM (SELECT house, tie, left_, votes, unnest(range(least_, most_)) AS k FROM {name}_bounds WHERE most_ > least_))
  WHERE rank <= left_ GROUP BY house, tie),
{name} AS (
  SELECT b.*, coalesce(least_, 0) + coalesce(won, 0) AS quota FROM {name}_bounds b LEFT JOIN {name}_won USING (house, tie))"""


SQL = rf"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS place
  FROM documents),
rows AS (SELECT *, place % greatest(1, ceil(sqrt((SELECT count(*) FROM docs)) / 2))::BIGINT AS shard FROM docs),
cells AS (SELECT source, shard, sum(size)::BIGINT AS cell_size FROM rows GROUP BY ALL),
sizes AS (
  SELECT source, sum(cell_size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS tie,
         [{', '.join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1]::DOUBLE AS weight
  FROM cells GROUP BY source),
summed AS (
  SELECT *, sum({MOST_COPIES} * source_size) OVER (ORDER BY {MOST_COPIES} * source_size / weight)::DOUBLE AS caps,
         sum(weight) OVER (ORDER BY {MOST_COPIES} * source_size / weight) AS weights,
         sum(source_size) OVER ()::DOUBLE AS total, sum(weight) OVER () AS all_weights FROM sizes),
marked AS (SELECT *, total - caps >= {MOST_COPIES} * source_size / weight * (all_weights - weights) AS capped FROM summed),
targets AS (
  SELECT source, source_size, tie, 0 AS house, round(total / {BLOCK_WORDS}) AS seats,
         CASE WHEN capped THEN ({MOST_COPIES} * source_size)::DOUBLE
              ELSE (total - sum(CASE WHEN capped THEN {MOST_COPIES} * source_size ELSE 0 END) OVER ())::DOUBLE * weight
                   / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () END AS votes FROM marked),
{_apportion_sql("quotas", "targets")},
parties AS (
  SELECT c.source, shard AS tie, cell_size, source_size, q.votes AS target, q.tie AS house, quota::DOUBLE AS seats,
         CASE WHEN source_size > 0 THEN q.votes * cell_size / source_size ELSE 0 END AS votes
  FROM cells c JOIN quotas q ON c.source IS NOT DISTINCT FROM q.source),
{_apportion_sql("dealt", "parties")},
cell AS (
  SELECT *, wanted // cell_size AS rounds, wanted % cell_size AS rest, place % cell_size AS start FROM (
    SELECT source, tie AS shard, source_size, target, nullif(cell_size, 0) AS cell_size,
           least(quota * {BLOCK_WORDS}, cell_size * {MOST_COPIES})::BIGINT AS wanted,
           ('0x' || substr(md5('{SEED}|' || house || '|' || tie), 1, 15))::BIGINT AS place FROM dealt)),
lined AS (
  SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY place, size ROWS UNBOUNDED PRECEDING)::BIGINT AS after FROM rows)
SELECT doc_id, size, source_size, target,
       (coalesce(rounds * size, 0)
        + greatest(least(after, start + rest) - greatest(after - size, start), 0)
        + greatest(least(after, start + rest - cell_size) - greatest(after - size, 0), 0))::BIGINT AS taken
FROM lined l JOIN cell c ON l.source IS NOT DISTINCT FROM c.source AND l.shard = c.shard"""

QUERY = Query("op3_source_mixture", op3, SQL)
