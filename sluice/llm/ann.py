"""Exact nearest neighbours by a block matrix join.

Queries and rows are dealt into blocks and every pair of blocks is one tile of
work.  In a tile, vectors are quantised to int8 and one integer matrix product
gives all inner products up to an error that is bounded per pair:
``|x.y - x'.y'| <= |x-x'| |y'| + |x| |y-y'|`` for the quantised x', y'.  Pairs
whose upper bound reaches a query's k-th best lower bound survive; only they
are computed in double precision, on the original vectors, component after
component.  A heap for each query keeps the best of a task's tiles, and the
tasks' winners (k for each query and block) are ranked at the end.  Nothing is
missed: the result equals a full search.

Blocks are bounded (``MAX_BLOCK`` rows), so is what a task holds; queries are
copied once for each block of rows and rows once for each block of queries.

Defined results: rows whose id or vector is null, and vectors that are empty,
zero or hold a null or non-finite component take no part; vectors of another
length than the query's are no candidates of it; a row is never a candidate of
a query with the same id; rows that repeat an id are candidates each, and as
queries count once (the vector that sorts first); ties go to the smaller id;
with fewer than k candidates all are returned; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import materialise, read_table

MAX_BLOCK = 1 << 15
MIN_BLOCK = 256
TILE = 1024


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return vector.isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scale, |x|, |x'| and |x - x'|."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    near = q * scale[:, None]
    return q, scale, *(np.sqrt((v * v).sum(axis=1)) for v in (x, near, x - near))


def tile_bounds(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Quantised products of two blocks and their error bounds."""
    dim = a[0].shape[1]
    # Integer products of int8 values are exact in this float type, and fast.
    kind = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64
    product = (a[0].astype(kind) @ b[0].astype(kind).T).astype(np.float64) * a[1][:, None] * b[1][None, :]
    error = a[4][:, None] * b[3][None, :] + a[2][:, None] * b[4][None, :]
    return product, error + 1e-12 * a[2][:, None] * b[2][None, :]


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, summed from the first component to the last."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * y[:, d]
    return total


def search_block(q_ids: np.ndarray, q: np.ndarray, r_ids: np.ndarray, r: np.ndarray, k: int) -> list[tuple[int, float, int]]:
    """(query, score, row) of each query's k best rows."""
    out = []
    rows = [(r_ids[at:at + TILE], r[at:at + TILE], quantise(r[at:at + TILE])) for at in range(0, len(r), TILE)]
    for at in range(0, len(q), TILE):
        ids, x = q_ids[at:at + TILE], q[at:at + TILE]
        xq, heaps = quantise(x), [[] for _ in ids]  # each heap's root is its worst entry
        floor = np.full(len(ids), -np.inf)
        for y_ids, y, yq in rows:
            product, error = tile_bounds(xq, yq)
            own = ids[:, None] == y_ids[None, :]
            lower = np.where(own, -np.inf, product - error)
            if lower.shape[1] >= k:
                floor = np.maximum(floor, np.partition(lower, -k, axis=1)[:, -k])
            i, j = np.nonzero((product + error >= floor[:, None]) & ~own)
            score = exact_products(x[i], y[j])
            for a, s, b in zip(i.tolist(), score.tolist(), y_ids[j].tolist(), strict=True):
                heap = heaps[a]
                if len(heap) < k:
                    heapq.heappush(heap, (s, -b))
                elif (s, -b) > heap[0]:
                    heapq.heapreplace(heap, (s, -b))
            full = [a for a in range(len(ids)) if len(heaps[a]) == k]
            floor[full] = np.maximum(floor[full], [heaps[a][0][0] for a in full])
        out += [(int(i), s, -b) for i, heap in zip(ids, heaps, strict=True) for s, b in heap]
    return out


def _matrices(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (ids, vectors in double precision)."""
    ids = table.column("id").to_numpy()
    lists = table.column("v").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lengths, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts, out = np.cumsum(lengths) - lengths, {}
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        out[int(n)] = ids[at], flat[starts[at][:, None] + np.arange(n)[None, :]]
    return out


def nearest(vectors: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
            max_block: int = MAX_BLOCK) -> DataFrame:
    """(query_id, rank, id, score): the k rows of largest inner product for each row that ``queries`` selects."""
    spark = vectors.sparkSession
    rows = (vectors.where(F.col(id_col).isNotNull() & _usable(F.col(vector_col)))
            .select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"),
                    F.coalesce(queries, F.lit(False)).alias("asks")))
    n, asking = rows.agg(F.count("*"), F.sum(F.col("asks").cast("long"))).first()
    slots = 4 * spark.sparkContext.defaultParallelism
    row_blocks = max(1, math.ceil(n / max_block), min(slots, math.ceil(n / MIN_BLOCK)))
    query_blocks = max(1, math.ceil((asking or 0) / max_block))
    block = lambda n, *cols: F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = rows.where("asks").select("id", "v", block(query_blocks, "id").alias("qb"), every(row_blocks).alias("rb"))
    given = rows.select("id", "v", every(query_blocks).alias("qb"), block(row_blocks, "id", "v").alias("rb"))

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, float, int]] = []
        theirs = _matrices(right)
        for length, (ids, x) in _matrices(left).items():
            order = np.lexsort((*x.T[::-1], ids))
            ids, x = ids[order], x[order]
            one = np.r_[True, ids[1:] != ids[:-1]]
            if length in theirs:
                found += search_block(ids[one], x[one], *theirs[length], k)
        cols = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "score": pa.array(cols[1], pa.float64()),
                         "id": pa.array(cols[2], pa.int64())})

    best = materialise(asked.groupBy("qb", "rb").cogroup(given.groupBy("qb", "rb"))
                       .applyInArrow(tile, "query_id long, score double, id long"), "ann-tiles")
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (best.withColumn("rank", place).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))


def op3_query(spark, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.e, r.e) AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id AND len(q.e) = len(r.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM p QUALIFY rank <= 20
"""
