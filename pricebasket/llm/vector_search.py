"""Exact nearest neighbours by a block matrix join of int8 tiles.

Vectors are quantised to int8 with a scale of their own and packed into blocks.
Query blocks meet candidate blocks in a grid: a tile's int8 product gives every
pair's distance up to a bound on the quantisation error.  Per query, a pair
whose lower bound is above the k-th smallest upper bound so far can't be among
the nearest; the pairs that survive are recomputed in double precision on the
original vectors, kept in a heap of k a query and tile, and the heaps are
merged a query.

The bound: with a = s*qa + ea and b = t*qb + eb, the errors' norms known
exactly, |distance(a, b) - distance(s*qa, t*qb)| <= |ea| + |eb|.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite
components take no part, as queries or candidates, and neither do rows without
an id; a query with no candidate has no row; ties go to the smaller vec_id.
Rows repeated with one id are several candidates for other queries and none
for that id's own; a query given twice counts once, and an id with several query
vectors gets the nearest over them.  Vectors of different lengths are never near
one another.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.llm.common import table, written

#: Queries and candidates of one block; a tile of products is QUERY_ROWS x STRIP.
QUERY_ROWS, ROWS, STRIP = 1024, 16_384, 2048


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, vec): the rows that take part, vectors as doubles."""
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where("id is not null and vec is not null")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vec", lambda x: x != 0.0)
    return rows.where(~F.coalesce(bad, F.lit(True)) & F.coalesce(some, F.lit(False)))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the norm of what the rounding left out
    (with room for its own rounding)."""
    scale = np.abs(x).max(1) / 127.0
    scale[scale == 0] = 1.0
    q = np.clip(np.rint(x / scale[:, None]), -127, 127)
    error = np.sqrt(((x - q * scale[:, None]) ** 2).sum(1))
    return q.astype(np.int8), scale, error * (1 + 1e-9) + 1e-12 * scale


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of row pairs, components summed in order."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += (a[:, d] - b[:, d]) ** 2
    return np.sqrt(total)


def tile_nearest(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, float, int]]:
    """(query's row, distance, candidate's id): per query the k nearest of the
    candidates other than itself."""
    heaps: list[list] = [[] for _ in q_ids]
    qi, qs, qe = quantise(q)
    # |scaled row|^2; int8 products are summed in float32, exact up to 2^24
    exact32 = c.shape[1] * 127 * 127 < 1 << 24
    kind = np.float32 if exact32 else np.float64
    qn = (qi.astype(np.float64) ** 2).sum(1) * qs ** 2
    limit = np.full(len(q_ids), np.inf)
    for at in range(0, len(c_ids), STRIP):
        ids, vec = c_ids[at:at + STRIP], c[at:at + STRIP]
        ci, cs, ce = quantise(vec)
        cn = (ci.astype(np.float64) ** 2).sum(1) * cs ** 2
        dot = (qi.astype(kind) @ ci.astype(kind).T).astype(np.float64) * qs[:, None] * cs
        about = np.sqrt(np.maximum(qn[:, None] + cn - 2 * dot, 0))
        room = qe[:, None] + ce + 1e-7 * (np.sqrt(qn)[:, None] + np.sqrt(cn))  # and the rounding of these sums
        own = q_ids[:, None] == ids
        upper = np.where(own, np.inf, about + room)
        if upper.shape[1] >= k:
            limit = np.minimum(limit, np.partition(upper, k - 1, axis=1)[:, k - 1])
        rows, cols = np.nonzero(~own & (about - room <= limit[:, None]))
        for s in range(0, len(rows), 200_000):
            r, j = rows[s:s + 200_000], cols[s:s + 200_000]
            for row, far, i in zip(r.tolist(), distances(q[r], vec[j]).tolist(), ids[j].tolist(), strict=True):
                heap, item = heaps[row], (-far, -i)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
        full = [row for row, h in enumerate(heaps) if len(h) == k]
        if full:
            limit[full] = np.minimum(limit[full], [-heaps[row][0][0] for row in full])
    return [(row, -far, -i) for row, h in enumerate(heaps) for far, i in h]


def _packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Blocks of at most ``size`` vectors of one length: (block, dim, ids, data), written."""
    schema = pa.schema([("block", pa.string()), ("dim", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())])

    def pack(batches):
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}

        def block(dim):
            nonlocal n
            ids, vecs = zip(*held.pop(dim), strict=True)
            n += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{task}-{n}"]), pa.array([dim], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([np.array(vecs, np.float64).tobytes()], pa.binary())], schema=schema)

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(len(v), []).append((i, v))
                if len(held[len(v)]) >= size:
                    yield block(len(v))
        for dim in sorted(held):
            yield block(dim)

    return written(rows.mapInArrow(pack, "block string, dim int, ids binary, data binary"), name)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest of ``vectors``
    other than rows of its own id."""
    q = _packed(usable(queries, id_col, vec_col).dropDuplicates(), QUERY_ROWS, "knn-queries")
    c = _packed(usable(vectors, id_col, vec_col), ROWS, "knn-candidates")
    # the grid: every candidate block meets every query block of its length once;
    # rows here are blocks, and a join key per pair of them deals the tiles evenly
    q_blocks = q.select("block", "dim").withColumnRenamed("block", "q_block")
    grid = c.select("block", "dim").join(q_blocks, "dim").select("block", "q_block")
    tiles = (grid.join(c.select("block", F.col("ids").alias("c_ids"), F.col("data").alias("c_data"), "dim"), "block")
             .join(q.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data")), "q_block"))
    tiles = tiles.repartition(F.col("block"), F.col("q_block"))
    schema = pa.schema([("query_id", pa.int64()), ("score", pa.float64()), ("vec_id", pa.int64())])

    def search(batches):
        for b in batches:
            for dim, qi, qd, ci, cd in zip(*(x.to_pylist() for x in b.columns), strict=True):
                q_ids = np.frombuffer(qi, np.int64)
                found = tile_nearest(q_ids, np.frombuffer(qd).reshape(-1, dim), np.frombuffer(ci, np.int64),
                                     np.frombuffer(cd).reshape(-1, dim), k)
                rows, far, ids = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[list(rows)]), pa.array(far, pa.float64()),
                                                  pa.array(ids, pa.int64())], schema=schema)

    near = tiles.select("dim", "q_ids", "q_data", "c_ids", "c_data").mapInArrow(
        search, "query_id long, score double, vec_id long")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        """The k nearest of a query's heaps (k rows a tile)."""
        best = heapq.nsmallest(k, zip(pdf["score"].tolist(), pdf["vec_id"].tolist(), strict=True))
        return pd.DataFrame({"query_id": pdf["query_id"].iloc[0], "rank": range(1, len(best) + 1),
                             "vec_id": [i for _, i in best], "score": [s for s, _ in best]})

    return near.groupBy("query_id").applyInPandas(merge, "query_id long, rank int, vec_id long, score double")


def op10_vector_search(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


ORACLE_OP10 = """
WITH ok AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score
  FROM ok q JOIN ok c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS r FROM pairs
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10
"""
