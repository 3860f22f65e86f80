"""Exact search for the highest inner products: a ball tree for each shard, branch and bound over it."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Query, col, stored, table

#: Production parameters.
K, SCALE, EVERY = 20, 64, 20
#: Vectors of a shard, queries of a block, and vectors of a leaf of the tree.
SHARD, BLOCK, LEAF = 8192, 8192, 128


class BallTree:
    """Whole-number vectors (rows of ``x``) in nested balls. ``ids`` are in ascending order."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x.astype(float)
        self.nodes: list[tuple[np.ndarray, float, np.ndarray, int, int]] = []
        if len(ids):
            self._build(np.arange(len(ids)))

    def _build(self, rows: np.ndarray) -> int:
        points = self.x[rows]
        centre = points.mean(axis=0)
        # A hair more than the largest distance, so that rounding never cuts a point off.
        radius = float(np.sqrt(((points - centre) ** 2).sum(axis=1).max())) * (1 + 1e-9) + 1e-9
        at = len(self.nodes)
        self.nodes.append((centre, radius, rows, -1, -1))
        if len(rows) > LEAF and radius > 1e-6 and points.shape[1]:
            # Split at the middle along the line through two far points.
            far = points[((points - centre) ** 2).sum(axis=1).argmax()]
            along = points @ (points[((points - far) ** 2).sum(axis=1).argmax()] - far)
            order = np.argsort(along, kind="stable")
            left, right = self._build(np.sort(rows[order[:len(rows) // 2]])), self._build(np.sort(rows[order[len(rows) // 2:]]))
            self.nodes[at] = (centre, radius, rows, left, right)
        return at

    def search(self, query_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of queries, ids and scores: the ``k`` best of this tree for each query, other than its own id.

        ``bound`` is the k-th best score known from elsewhere; what cannot reach it is left out. Each query goes
        first to the child ball with the higher bound, the other child is left out once the k-th score beats it. All
        queries at a node go on together.
        """
        n, q = len(query_ids), q.astype(float)
        norm = np.sqrt((q ** 2).sum(axis=1)) * (1 + 1e-9)
        best, who = np.full((n, k), -np.inf), np.full((n, k), len(self.ids))
        kth = bound.astype(float).copy()

        def upper(node: int, act: np.ndarray) -> np.ndarray:
            centre, radius = self.nodes[node][:2]
            return q[act] @ centre + norm[act] * radius + 1e-6

        def leaf(rows: np.ndarray, act: np.ndarray) -> None:
            scores = np.rint(q[act] @ self.x[rows].T)
            scores[self.ids[rows][None, :] == query_ids[act][:, None]] = -np.inf
            hopeful = (scores >= kth[act][:, None]).any(axis=1)
            act, scores = act[hopeful], scores[hopeful]
            if not len(act):
                return
            s = np.concatenate((best[act], scores), axis=1)
            w = np.concatenate((who[act], np.broadcast_to(rows, scores.shape)), axis=1)
            # Equal scores: the smaller id, which is the smaller row.
            order = np.lexsort((w, -s), axis=1)[:, :k]
            best[act], who[act] = np.take_along_axis(s, order, 1), np.take_along_axis(w, order, 1)
            kth[act] = np.maximum(kth[act], best[act, -1])

        def visit(node: int, act: np.ndarray) -> None:
            act = act[upper(node, act) >= kth[act]]
            if not len(act):
                return
            _, _, rows, left, right = self.nodes[node]
            if left < 0:
                leaf(rows, act)
                return
            first = upper(left, act) >= upper(right, act)
            a, b = act[first], act[~first]
            for child, some in ((left, a), (right, b), (right, a), (left, b)):
                if len(some):
                    visit(child, some)

        if self.nodes and n:
            visit(0, np.arange(n))
        place, rank = np.nonzero((who < len(self.ids)) & (best > -np.inf) & (best >= bound[:, None]))
        return place, self.ids[who[place, rank]], best[place, rank].astype(np.int64)


def _matrix(batch: pa.Table, ids: str, vectors: str, *more: str) -> list[tuple]:
    """Ids, vectors and further columns as arrays, by the length of the vectors; ids in ascending order."""
    if not batch.num_rows:
        return []
    batch = batch.sort_by(ids)
    v = batch.column(vectors).combine_chunks()
    lengths = np.diff(v.offsets.to_numpy())
    flat = v.flatten().to_numpy(zero_copy_only=False)
    out, ends = [], np.cumsum(lengths)
    columns = [batch.column(c).to_numpy() for c in (ids, *more)]
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        at = (ends[rows] - d)[:, None] + np.arange(d)
        out.append((int(d), [c[rows] for c in columns], flat[at] if d else np.zeros((len(rows), 0))))
    return out


def _found(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    a, b, c = (np.concatenate([p[i] for p in parts] or [np.empty(0, np.int64)]) for i in range(3))
    return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.int64())})


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``id`` and ``v``, the components as floor(scale * x), of the vectors that take part."""
    x = col(vector_col)
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    part = vectors.filter(x.isNotNull() & fine & col(id_col).isNotNull())
    return part.select(col(id_col).cast("long").alias("id"), F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long")).alias("v"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: for each query the ``k`` vectors of the highest inner products.

    Both sides are (id, v) with whole numbers; a query does not find its own id, equal scores go to the smaller id, and
    vectors of another length than the query's are not compared. Of rows that repeat an id, the one with the
    least vector counts. No vectors or no queries give an empty result.

    Vectors are dealt by a hash of their id to shards of about ``shard``. A query is first answered by the one shard that its
    own hash names; its k-th score there then is the bound with which all other shards are searched. Queries meet these
    in blocks of about ``block``, so that a task holds one shard and one block, whatever their numbers.
    """
    vectors = stored(vectors.groupBy("id").agg(F.min("v").alias("v")), "vectors")
    queries = stored(queries.groupBy("id").agg(F.min("v").alias("v")), "queries")
    shards, blocks = max(1, ceil(vectors.count() / shard)), max(1, ceil(queries.count() / block))
    own = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    group = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")
    # As many copies of a vector as there are blocks of queries, of a query as there are shards: what a search of
    # all queries against all vectors needs.
    sides = vectors.withColumns({"shard": own, "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    asks = queries.withColumns({"home": own, "block": group})
    found = "query_id long, vec_id long, score long"

    def search(key: tuple, side: pa.Table, asked: pa.Table) -> pa.Table:
        trees = {d: BallTree(ids, x) for d, (ids,), x in _matrix(side, "id", "v")} if asked.num_rows else {}
        parts = []
        for d, (ids, bound), q in _matrix(asked, "id", "v", "bound"):
            if d in trees:
                place, hits, scores = trees[d].search(ids, q, bound, k)
                parts.append((ids[place], hits, scores))
        return _found(parts)

    def searched(asked: DataFrame) -> DataFrame:
        return sides.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(search, found)

    first = stored(searched(asks.select("id", "v", F.col("home").alias("shard"), "block", F.lit(float("-inf")).alias("bound"))), "first-shard")
    bounds = first.groupBy(F.col("query_id").alias("id")).agg(
        F.when(F.count("*") >= k, F.min("score").cast("double")).otherwise(F.lit(float("-inf"))).alias("bound"))
    others = asks.join(bounds, "id", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("shard <> home")
    rest = searched(others.select("id", "v", "shard", "block", F.coalesce("bound", F.lit(float("-inf"))).alias("bound")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return first.unionAll(rest).withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5(spark: SparkSession, folder: str) -> DataFrame:
    vectors = whole_numbers(table(spark, folder, "embeddings"), "vec_id", "embedding")
    return top_k(vectors, vectors.filter(F.col("id") % EVERY == 0))


SQL = f"""
WITH numbers AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM numbers q JOIN numbers c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {EVERY} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}"""

QUERY = Query("op5_topk_search", op5, SQL)
