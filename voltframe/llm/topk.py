"""Exact top-k inner-product search by block-at-a-time pruning.

Components become whole numbers, floor(1024 * x), and count as terms. Rows are dealt to shards by a hash of the id,
queries to groups; each shard meets each group of queries in one task of bounded size. There, rows are put in an order
that has like ones side by side and cut into blocks. A block keeps each term's largest and smallest value and a forward
index (its rows' values). For each query, blocks come in order of the bound that these extremes give, and are scored
through their forward index until a bound falls below the query's k-th score. The k best of every shard then merge.

Vectors that are null, or hold a null or a component that isn't finite, take no part. Shorter vectors count as if
filled with zeros. Equal scores go to the smaller id; a query's own row (any row of its id) is no candidate; of queries
that share an id, the least vector asks. Scores beyond 64 bits are held at the nearest 64-bit number. Rows with a null
id take no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, ship

K, BLOCK = 10, 64
#: Rows of a shard and queries of a group, about.
SHARD_ROWS, GROUP_QUERIES = 16_384, 2_048
#: Products of numbers up to this size sum exactly in doubles for any usual dimension.
SMALL = 1 << 20


def whole(x: float) -> int:
    """floor(1024 * x), exactly."""
    return math.floor(1024 * x) if abs(x) < 2.0**53 else 1024 * int(x)


def matrix(vectors: list[list[float]], width: int) -> np.ndarray:
    """Rows of floor(1024 * x): doubles where their products sum exactly, else Python's whole numbers."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    if width <= 4096 and np.abs(out).max(initial=0) <= SMALL / 1024:
        return np.floor(1024 * out)
    return np.array([[whole(x) for x in v] for v in out.tolist()], object).reshape(out.shape)


def order_alike(m: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """An order of rows with like ones side by side: by the most similar of some evenly spaced rows, then by how similar."""
    if m.dtype == object or len(m) <= block:
        return np.arange(len(m))
    leaders = m[:: max(1, len(m) // max(1, len(m) // block))]
    likeness = m @ leaders.T - 0.5 * (leaders * leaders).sum(1)
    nearest = likeness.argmax(1)
    return np.lexsort((-likeness.max(1), nearest))


def search(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int = K, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's number, row id, score) of the k best rows of each query; and how well it prunes is seen in ``search.scored``."""
    order = order_alike(rows, block)
    rows, row_ids = rows[order], row_ids[order]
    starts = np.arange(0, len(rows), block)
    high = np.maximum.reduceat(rows, starts, axis=0)
    low = np.minimum.reduceat(rows, starts, axis=0)
    up = np.where(queries > 0, queries, 0)
    bounds = up @ high.T + (queries - up) @ low.T  # (queries, blocks)
    turn = np.argsort(-bounds, axis=1, kind="stable")
    n, worst = len(queries), -np.inf if rows.dtype != object else -(1 << 200)
    best = np.full((n, k), worst, rows.dtype)
    best_ids = np.full((n, k), np.iinfo(np.int64).max)
    live = np.arange(n)
    search.scored = 0
    for step in range(len(starts)):
        b = turn[live, step]
        going = bounds[live, b] >= best[live, -1]  # an equal score may have a smaller id
        live, b = live[going], b[going]
        if not len(live):
            break
        # queries that are at the same block share its forward index
        by_block = np.argsort(b, kind="stable")
        live, b = live[by_block], b[by_block]
        cuts = np.flatnonzero(np.diff(b)) + 1
        for part in np.split(np.arange(len(b)), cuts):
            s = starts[b[part[0]]]
            ids, q = row_ids[s : s + block], live[part]
            scores = queries[q] @ rows[s : s + block].T
            scores = np.where(ids[None, :] == query_ids[q][:, None], worst, scores)
            search.scored += scores.size
            hit = (scores >= best[q, -1:]).any(1)
            if not hit.any():
                continue
            q, scores = q[hit], scores[hit]
            all_scores = np.concatenate([best[q], scores], axis=1)
            all_ids = np.concatenate([best_ids[q], np.broadcast_to(ids, scores.shape)], axis=1)
            if rows.dtype == object:
                pick = np.array([sorted(range(len(x)), key=lambda j: (-x[j], y[j]))[:k] for x, y in zip(all_scores, all_ids, strict=True)])
            else:
                pick = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            best[q], best_ids[q] = np.take_along_axis(all_scores, pick, 1), np.take_along_axis(all_ids, pick, 1)
    real = best != worst
    return np.nonzero(real)[0], best_ids[real], best[real]


def top_k(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, shard_rows: int = SHARD_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of each query."""
    spark = vectors.sparkSession
    ship(spark)
    x = F.col(vector_col)
    fine = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), x.cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    counts = rows.agg(F.count("*"), F.count_if("q")).first()
    shards, groups = max(1, -(-counts[0] // shard_rows)), max(1, -(-counts[1] // group_queries))

    def number(of: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(of)).cast("int")

    given = rows.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), number(shards, 1).alias("s"), "id", "v", F.lit(False).alias("q"))
    asked = rows.where("q").groupBy("id").agg(F.min("v").alias("v")).select(number(groups, 2).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("s"), "id", "v", F.lit(True).alias("q"))

    def run(table: pa.Table) -> pa.Table:
        kinds, ids = table["q"].to_numpy(), table["id"].to_numpy()
        values = table["v"].to_pylist()
        m = matrix(values, max(map(len, values)))
        if kinds.all() or not kinds.any():
            found = np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0)
            asked_ids = ids
        else:
            asked_ids = ids[kinds]
            found = search(m[kinds], asked_ids, m[~kinds], ids[~kinds], k)
        scores = [max(-(2**63), min(2**63 - 1, int(s))) for s in found[2]]
        return pa.table({"query_id": pa.array(asked_ids[found[0]], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(scores, pa.int64())})

    near = given.unionAll(asked).groupBy("g", "s").applyInArrow(run, "query_id long, vec_id long, score long")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
