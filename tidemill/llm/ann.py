"""Approximate nearest neighbours with a permutation index."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.base import stored

#: pivots and how many of the nearest ones stand for a vector
PIVOTS, NEAREST = 256, 64
#: rows of a batch that are reranked: this share, and this many at least
RERANKED, LEAST_RERANKED = 0.15, 1024
#: queries that are searched for in one pass over the index
QUERY_BLOCK = 8192
#: candidates of a query that one last window holds, times k
TREE = 64


@dataclass
class Pivots:
    """Bounded sample of the rows.  A row counts as one number longer, so that all are of the length ``reach``: then the
    nearest pivots of a query are those of the largest inner product, whatever the lengths of the rows."""

    points: np.ndarray
    reach: float

    def near(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """The nearest pivots of each vector, nearest first."""
        extra = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.reach**2 - (vectors**2).sum(axis=1), 0))
        close = vectors @ self.points[:, :-1].T + extra[:, None] * self.points[:, -1]
        return np.argsort(-close, axis=1, kind="stable")[:, :NEAREST].astype(np.int16)


def usable(vector: str, size: int) -> Column:
    """Whether a vector takes part: of that size, all its numbers finite, and not all 0."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) == size) & ~bad & F.exists(vector, lambda x: x != 0)


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def build_index(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, Pivots | None]:
    """The written index (vec_id, vector, near) of all rows that take part, and its pivots.

    The commonest size of a vector is that of all that take part.  The rows with the least hashes are the pivots.
    """
    rows = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    sizes = rows.where("size(vector) > 0").groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = sizes["size"] if sizes else 1
    rows = rows.where(usable("vector", size))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    reach = rows.agg(F.max(norm)).first()[0]
    chosen = rows.orderBy(F.xxhash64("vec_id", F.lit("pivots")), "vec_id", "vector").limit(PIVOTS).collect()
    points = np.array([r["vector"] for r in chosen], dtype=float).reshape(len(chosen), size)
    reach = reach or 1.0
    pivots = Pivots(np.hstack([points, np.sqrt(np.maximum(reach**2 - (points**2).sum(axis=1), 0))[:, None]]), reach)

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = pivots.near(_matrix(b, "vector"), query=False)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(near.ravel()), near.shape[1]).cast(pa.list_(pa.int16()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("vector"), lists], ["vec_id", "vector", "near"])

    index = rows.mapInArrow(order, "vec_id bigint, vector array<double>, near array<smallint>") if chosen else rows.withColumn("near", F.lit(None).cast("array<smallint>"))
    return stored(index, "permutation-index"), pivots if chosen else None


def postings(near: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pivot the rows that have it among their nearest, and what it counts there: NEAREST less its place."""
    row, place = np.divmod(np.arange(near.size), near.shape[1])
    flat = near.ravel()
    order = np.argsort(flat, kind="stable")
    ends = np.searchsorted(flat[order], np.arange(pivots + 1))
    row, worth = row[order].astype(np.int32), (NEAREST - place[order]).astype(np.int16)
    return [(row[a:b], worth[a:b]) for a, b in zip(ends, ends[1:])]


def search_block(ids: np.ndarray, vectors: np.ndarray, near: np.ndarray, queries: tuple, pivots: int, k: int) -> tuple[np.ndarray, ...]:
    """query, vec_id, score of the k best rows of a block for each query.

    With absent pivots in the place behind the last, the footrule distance of two orders is a constant less twice
    the sum, over pivots in both, of NEAREST less the later place: that sum is read off the posting lists.
    """
    lists = postings(near, pivots)
    q_ids, q_vectors, q_near = queries
    n = len(ids)
    most = min(n, max(4 * k, LEAST_RERANKED, int(n * RERANKED)))
    out_q, out_v, out_s = [], [], []
    worth = np.arange(NEAREST, 0, -1, dtype=np.int16)
    for q, vector, order in zip(q_ids, q_vectors, q_near):
        common = np.zeros(n, dtype=np.int16)
        for p, w in zip(order.tolist(), worth):
            rows, there = lists[p]
            common[rows] += np.minimum(there, w)
        rows = np.argpartition(-common, most - 1)[:most] if most < n else np.arange(n)
        rows = rows[ids[rows] != q]
        score = vectors[rows] @ vector
        best = np.lexsort((ids[rows], -score))[:k]
        out_q.append(np.full(len(best), q))
        out_v.append(ids[rows][best])
        out_s.append(score[best])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def _merged(parts: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    q, v, s = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    first = np.r_[0, np.flatnonzero(q[1:] != q[:-1]) + 1]
    keep = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)])) < k
    return q[keep], v[keep], s[keep]


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: of the rows whose id is divisible by ``every``, the k rows found nearest by inner
    product in double precision, nearest first, ties to the smaller id; the query's own row is none of them.

    Every row is in the index: the order of its ``NEAREST`` nearest pivots.  A block of queries at most
    ``QUERY_BLOCK`` large is sent to all parts of the index, where each batch of rows is posted by pivot; rows
    are ranked by the footrule distance of the orders and the best ``RERANKED`` share is ranked by the vectors themselves.
    Each task keeps k rows per query, and windows over ``TREE`` tasks' rows at a time make one list of them.

    Null ids, null, empty and zero vectors, vectors with null or non-finite numbers, and vectors of another than the
    commonest size take no part.  Fewer candidates than k give fewer rows.  Repeated rows are candidates each; a
    repeated query is asked once, by the first of its vectors in order.  Other columns are not read.
    """
    spark = vectors.sparkSession
    index, pivots = build_index(vectors, id_col, vector_col)
    asked = index.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    ids = stored(asked, "queries")
    total = ids.count()
    passes = max(1, -(-total // QUERY_BLOCK))
    found = []
    for part in range(passes if pivots else 0):
        block = ids.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == part) if passes > 1 else ids
        rows = block.orderBy("vec_id").collect()
        if not rows:
            continue
        q_vectors = np.array([r["vector"] for r in rows], dtype=float)
        queries = (np.array([r["vec_id"] for r in rows], dtype=np.int64), q_vectors, pivots.near(q_vectors, query=True))
        found.append(_search(index, queries, len(pivots.points), k))
        if passes > 1:
            found[-1] = stored(found[-1], "found")
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    by_score = [F.desc("score"), "vec_id"]
    for keys in (["query_id", (F.col("task") / TREE).cast("int")], ["query_id"]):
        out = out.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by_score))).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def _search(index: DataFrame, queries: tuple, pivots: int, k: int) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, task = None, TaskContext.get().partitionId()
        for b in batches:
            if not b.num_rows:
                continue
            here = search_block(b.column("vec_id").to_numpy(), _matrix(b, "vector"), _matrix(b, "near"), queries, pivots, k)
            best = here if best is None else _merged([best, here], k)
        if best is not None:
            q, v, s = (pa.array(x) for x in best)
            yield pa.RecordBatch.from_arrays([q, v, s, pa.array(np.full(len(q), task, dtype=np.int32))], ["query_id", "vec_id", "score", "task"])

    return index.mapInArrow(search, "query_id bigint, vec_id bigint, score double, task int")
