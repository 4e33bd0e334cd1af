"""Operator 1: exact top-k search by inner product, as columnar branch and bound.

Vectors become integers, floor(256 * x). Rows are dealt into blocks of bounded size, and
each pair of a query block and a candidate block is one unit of work, so a unit's memory is
bounded and the units spread over all tasks. In a unit the candidates lie in
vertical layout; partial scores accumulate one dimension block at a time, and after
each the candidates whose upper bound (partial score plus the product of the remaining
norms) is below the k-th best lower bound are compacted away. Each unit returns
its own best k, and a window ranks those of all units.

Defined results: vectors that are null, or hold null or non-finite components, and rows with a
null id take no part; vectors are compared with those of their own length (empty ones score 0);
repeated rows are candidates of each other, as only the query's own row is left out; ties go to
the smaller id; an empty table gives an empty one; components beyond the range of long, and
scores beyond it, are held at its ends; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .base import ship_code, tidy, written

K = 5
QUERY_BLOCK, CANDIDATE_BLOCK, DIMENSIONS = 256, 2048, 8
LONG = 1 << 63


def integers(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(rid, vec_id, v array<long>) of the rows that take part."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("vec_id"), x.alias("x"), good.alias("good"))
    return rows.where(F.col("good") & F.col("vec_id").isNotNull()).select(
        "rid", "vec_id", F.transform("x", lambda c: F.floor(F.lit(256.0) * c).cast("long")).alias("v"))


def _blocks(rows: DataFrame, size: int, name: str, n: int) -> DataFrame:
    """Rows gathered in about n / size blocks a vector length: (dim, <name>, <name>_rows)."""
    return (rows.groupBy(F.size("v").alias("dim"), F.pmod(F.xxhash64("rid"), F.lit(max(1, math.ceil(n / size)))).alias(name))
            .agg(F.collect_list(F.struct("rid", "vec_id", "v")).alias(f"{name}_rows")))


def _norms(m: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Euclidean norms of what lies beyond each cut, for the columns of (dimension, row)."""
    sq = np.square(m.astype(np.float64))
    return np.stack([np.sqrt(sq[c:].sum(axis=0)) for c in cuts])


def _exact(q: np.ndarray, c: np.ndarray) -> bool:
    """Whether all sums of the products fit a double's whole numbers."""
    most = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (q, c)]
    return most[0] * most[1] * max(1, len(q)) < 2.0 ** 52


def block_top(q: np.ndarray, q_rid: np.ndarray, c: np.ndarray, c_rid: np.ndarray, c_id: np.ndarray, k: int) -> list[tuple]:
    """(query row, candidate row, score) of the best k of each query; q and c are (dimension, row)."""
    dims, out = len(q), []
    if not _exact(q, c):
        return _plain_top(q, q_rid, c, c_rid, c_id, k)
    q, c = q.astype(np.float64), c.astype(np.float64)
    cuts = [*range(DIMENSIONS, dims, DIMENSIONS), dims]
    q_rest, c_rest = _norms(q, cuts), _norms(c, cuts)
    first = q[:cuts[0]].T @ c[:cuts[0]]  # the first block of dimensions, for all queries at once
    for j in range(q.shape[1]):
        left = np.flatnonzero(c_rid != q_rid[j])
        part = first[j][left]
        for b, cut in enumerate(cuts):
            if b:
                at = cuts[b - 1]
                part = part + q[at:cut, j] @ c[at:cut][:, left]
            if len(left) > k and cut < dims:
                slack = q_rest[b, j] * c_rest[b][left] * (1 + 1e-9) + 1
                floor = np.partition(part - slack, len(left) - k)[len(left) - k]
                stays = part + slack >= floor
                left, part = left[stays], part[stays]
        best = np.lexsort((c_rid[left], c_id[left], -part))[:k]
        out += [(j, int(left[i]), int(part[i])) for i in best]
    return out


def _plain_top(q, q_rid, c, c_rid, c_id, k) -> list[tuple]:
    """Whole numbers of any size, for components that a double's sums can't hold."""
    out, c = [], c.astype(object)
    for j in range(q.shape[1]):
        scores = q[:, j].astype(object) @ c if len(c) else np.zeros(c.shape[1], dtype=object)
        left = [i for i in range(c.shape[1]) if c_rid[i] != q_rid[j]]
        left.sort(key=lambda i: (-scores[i], c_id[i], c_rid[i]))
        out += [(j, i, max(-LONG, min(LONG - 1, int(scores[i])))) for i in left[:k]]
    return out


def _matrix(rows: pa.ListArray, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    s = rows.flatten()
    v = np.asarray(s.field("v").flatten(), dtype=np.int64).reshape(len(s), dim)
    return np.asarray(s.field("rid")), np.asarray(s.field("vec_id")), np.ascontiguousarray(v.T)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_rid, query_id, rank, vec_id, score) of every row that ``is_query`` holds for.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    ship_code(vectors.sparkSession)
    rows = written(integers(vectors, id_col, vec_col), "topk-vectors")
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    queries = _blocks(rows.where(is_query), QUERY_BLOCK, "qb", n_queries)
    cands = _blocks(rows, CANDIDATE_BLOCK, "cb", n)

    def every(n, size, name):
        return F.explode(F.sequence(F.lit(0), F.lit(max(1, math.ceil(n / size)) - 1))).alias(name)

    pairs = (queries.select("*", every(n, CANDIDATE_BLOCK, "cb")).hint("shuffle_hash").join(cands.select("*", every(n_queries, QUERY_BLOCK, "qb")), ["dim", "qb", "cb"])
             .select("dim", "qb_rows", "cb_rows"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column(0)[i].as_py()
                q_rid, q_id, q = _matrix(batch.column(1).slice(i, 1), dim)
                c_rid, c_id, c = _matrix(batch.column(2).slice(i, 1), dim)
                got = block_top(q, q_rid, c, c_rid, c_id, k)
                j, at, score = (np.array(x, dtype=np.int64) for x in (zip(*got, strict=True) if got else ([], [], [])))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (q_rid[j], q_id[j], c_rid[at], c_id[at], score)],
                                                 names=["query_rid", "query_id", "rid", "vec_id", "score"])

    best = pairs.mapInArrow(tidy(run), "query_rid long, query_id long, rid long, vec_id long, score long")
    order = Window.partitionBy("query_rid").orderBy(F.desc("score"), "vec_id", "rid")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_rid", "query_id", "rank", "vec_id", "score")


def op1(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    return top_k(vectors, F.col("vec_id") % 50 == 0).drop("query_rid")


ORACLE = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
