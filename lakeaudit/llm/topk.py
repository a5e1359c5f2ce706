"""Exact top-k search by tiled matrix products.

Rows are dealt into shards and queries into tiles, both of bounded size. A task multiplies the
queries of one tile with the vectors of one shard, block by block, keeps the k best of every block
(partial selection), and the partial lists of a query are merged in two levels of a tree.

Defined results
  * A vector takes part if it is not null and has only finite components; a null id takes no part.
  * Components become ``floor(scale * x)`` with x as double; scores are integer inner products.
    Products that fit 53 bits run as float64 matrix products, which are exact there; larger ones run
    in 64-bit integers (sums beyond 64 bits are not defined).
  * A query meets every row but those with its own id. Rows of another length than the query's have
    no inner product with it and are passed over.
  * Repeated rows are candidates each; of repeated queries one id counts once (its largest vector).
  * Ties go to the smaller id. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.llm.common import ready

#: Rows of a shard and queries of a tile: what one task holds.
SHARD_ROWS = 65_536
TILE_QUERIES = 16_384
#: Shards at least, so that small tables too are searched by many tasks.
LEAST_SHARDS = 64
#: Rows and queries of one matrix product.
BLOCK_ROWS = 4_096
BLOCK_QUERIES = 512

_PARTIAL = "query_id long, branch int, vec_id long, score long"


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(vec_id, v): vectors that take part, scaled and floored to integers."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    taking_part = F.col(id_col).isNotNull() & x.isNotNull() & ~bad
    return df.where(taking_part).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("v"))


def _matrices(rows: pa.Table):
    """(ids, int64 matrix) per vector length."""
    ids = rows.column("vec_id").to_numpy()
    column = rows.column("v").combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat, starts = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield int(n), ids[at], flat[(starts[at][:, None] + np.arange(n)[None, :])].astype(np.int64)


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    if not queries.shape[1]:
        return np.zeros((len(queries), len(rows)), dtype=np.int64)
    most = float(np.abs(queries.astype(np.float64)).max()) * float(np.abs(rows.astype(np.float64)).max())
    if most * queries.shape[1] < 2.0**53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def _best(query_ids, ids, scores, k):
    """The k best of one block per query: partial selection, then every tie of the k-th score."""
    own = ids[None, :] == query_ids[:, None]
    low = np.iinfo(np.int64).min
    masked = np.where(own, low, scores)
    if masked.shape[1] > k:
        kth = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
        keep = (masked >= kth[:, None]) & ~own
    else:
        keep = ~own
    q, r = np.nonzero(keep)
    return query_ids[q], ids[r], scores[q, r]


def _top(query, vec, score, k):
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    first = np.concatenate([[True], query[1:] != query[:-1]]) if len(query) else np.zeros(0, bool)
    seat = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
    keep = seat < k
    return query[keep], vec[keep], score[keep]


def _cell(k: int):
    def multiply(key, queries: pa.Table, rows: pa.Table) -> pa.Table:
        lists = (np.zeros(0, np.int64),) * 3
        if queries.num_rows and rows.num_rows:
            by_length = {n: (ids, m) for n, ids, m in _matrices(queries)}
            for n, ids, vectors in _matrices(rows):
                if n not in by_length:
                    continue
                query_ids, query_vectors = by_length[n]
                for q in range(0, len(query_ids), BLOCK_QUERIES):
                    for r in range(0, len(ids), BLOCK_ROWS):
                        qs, rs = slice(q, q + BLOCK_QUERIES), slice(r, r + BLOCK_ROWS)
                        found = _best(query_ids[qs], ids[rs], _products(query_vectors[qs], vectors[rs]), k)
                        lists = tuple(np.concatenate(x) for x in zip(lists, _top(*found, k)))
                    lists = _top(*lists, k)
        branch = np.full(len(lists[0]), key[1].as_py() % 32, dtype=np.int32)
        return pa.table({"query_id": lists[0], "branch": branch, "vec_id": lists[1], "score": lists[2]})
    return multiply


def top_k(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = 1024.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best partners of every row where ``is_query`` holds."""
    ready(df.sparkSession)
    rows = whole_vectors(df, id_col, vector_col, scale)
    queries = whole_vectors(df.where(is_query), id_col, vector_col, scale)
    queries = queries.groupBy("vec_id").agg(F.max("v").alias("v"))
    counts = df.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(is_query, 1)).alias("queries")).first()
    shards = max(LEAST_SHARDS, -(-counts["rows"] // SHARD_ROWS))
    tiles = max(1, -(-counts["queries"] // TILE_QUERIES))

    def grid(frame: DataFrame, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        dealt = F.pmod(F.xxhash64("vec_id", "v"), F.lit(own_n)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(other_n - 1)))
        return frame.withColumn(own, dealt).withColumn(other, every)

    left = grid(queries, "tile", tiles, "shard", shards).groupBy("tile", "shard")
    right = grid(rows, "shard", shards, "tile", tiles).groupBy("tile", "shard")
    partial = left.cogroup(right).applyInArrow(_cell(k), _PARTIAL)
    for level in (["query_id", "branch"], ["query_id"]):
        w = Window.partitionBy(*level).orderBy(F.col("score").desc(), "vec_id")
        partial = partial.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return partial.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10(spark, sf_dir: str) -> DataFrame:
    from lakeaudit.llm.common import table

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id % 100 = 0 AND r.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""
