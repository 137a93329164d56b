"""Exact top-k search by inner product over an impact-ordered index, processed score at a time.

A shard of vectors is indexed by impact: each component is a posting whose quantised impact is its multiple of a step,
and the postings of one dimension and impact are a segment. Segments lie in strata of descending absolute impact. For a
block of queries a stratum's segments add their quantised contributions to all vectors at once, as one matrix product.
What postings not yet taken can still add to a vector is at most the query's norm times the norm of what is left of
the vector, remainders of the quantising included. Exactly scored leaders give a score that k vectors reach; a query
stops once few vectors can still reach it, or after the last stratum. All vectors that can reach it are then scored
exactly, in integers. Each shard's best k meet per query.

Vectors that are null, or hold null or non-finite components, and null ids take no part; shorter vectors count as
padded with zeros. Ties go to the smaller id. Rows that repeat an id are one row, with the smallest of its vectors. Fewer
candidates than k give fewer rows; empty tables give none. Columns besides the key and the vector play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release, stored

#: Vectors of a shard at most and (where there are tasks enough) at least, queries of a block, queries worked on at a time.
SHARD, LEAST, QUERIES, TOGETHER = 32_768, 2048, 16_384, 64
#: Quantised impacts of a sign, and the least absolute impact of each stratum.
LEVELS, STRATA = 48, (16, 5, 1)
#: A query stops when at most so many vectors, for each of the k wanted, may still be among the best.
FEW = 8


class Index:
    """Strata of impact-ordered segments of one shard of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], vectors[order].astype(np.int64)
        step = max(1, -(-int(np.abs(self.x).max(initial=0)) // LEVELS))
        impact = np.rint(self.x / step)
        size, left = np.abs(impact), self.x.astype(np.float64)
        self.strata: list[tuple[np.ndarray, np.ndarray]] = []
        for high, low in zip((np.inf, *STRATA), STRATA):
            taken = np.where((size < high) & (size >= low), impact * step, 0.0)
            left = left - taken
            self.strata.append((np.ascontiguousarray(taken.T), np.sqrt((left * left).sum(axis=1))))
        #: Postings of each stratum, and those that no stratum takes.
        self.postings = [int(np.count_nonzero(t)) for t, _ in self.strata]
        self.norms = np.sqrt((self.x.astype(np.float64) ** 2).sum(axis=1))
        self.taken = self.rescored = 0

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's place, id, score) of the best k for each query, its own id apart."""
        parts = [self._search(queries[i : i + TOGETHER], own[i : i + TOGETHER], i, k) for i in range(0, len(queries), TOGETHER)]
        place, at, scores = (np.concatenate(p) for p in zip(*parts)) if parts else (np.empty(0, np.int64),) * 3
        return place, self.ids[at], scores

    def _exact(self, queries: np.ndarray, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        self.rescored += len(at)
        return np.concatenate([(queries[q[i : i + 65_536]] * self.x[at[i : i + 65_536]]).sum(axis=1) for i in range(0, max(1, len(at)), 65_536)])

    def _search(self, queries: np.ndarray, own: np.ndarray, base: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        queries, n = queries.astype(np.int64), len(self.ids)
        q = queries.astype(np.float64)
        norm = np.sqrt((q * q).sum(axis=1))
        # the own row, which is no candidate
        mine = np.minimum(np.searchsorted(self.ids, own), n - 1)
        has = np.flatnonzero(self.ids[mine] == own)
        reach, floor = np.zeros((len(q), n)), np.full(len(q), -np.inf)
        open_, found = np.arange(len(q)), []
        lead = min(2 * k, n)
        for turn, (segments, left) in enumerate(self.strata):
            reach[open_] += q[open_] @ segments
            reach[has, mine[has]] = -np.inf
            self.taken += len(open_) * self.postings[turn]
            top = np.argpartition(-reach[open_], lead - 1, axis=1)[:, :lead] if lead < n else np.broadcast_to(np.arange(n), (len(open_), n))
            exact = self._exact(queries, np.repeat(open_, lead), top.ravel()).reshape(top.shape).astype(np.float64)
            exact[np.isneginf(np.take_along_axis(reach[open_], top, 1))] = -np.inf
            if lead > k:
                floor[open_] = np.maximum(floor[open_], -np.partition(-exact, k - 1, axis=1)[:, k - 1])
            # the product of the norms bounds what is left; the small share covers rounding
            slack = norm[open_, None] * (left + 1e-9 * self.norms)[None, :] + 1e-6
            possible = (reach[open_] + slack >= floor[open_, None]) & ~np.isneginf(reach[open_])
            done = possible.sum(axis=1) <= FEW * k
            if turn == len(self.strata) - 1:
                done[:] = True
            rows, at = np.nonzero(possible & done[:, None])
            found.append((open_[rows], at))
            open_ = open_[~done]
            if not len(open_):
                break
        rows, at = (np.concatenate(f) for f in zip(*found))
        scores = self._exact(queries, rows, at)
        order = np.lexsort((self.ids[at], -scores, rows))
        rows, at, scores = rows[order], at[order], scores[order]
        best = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        return rows[best] + base, at[best], scores[best]


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims)[None, :] < lengths[:, None]] = flat
    return out


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(key: Column, vector: Column) -> Column:
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return key.isNotNull() & vector.isNotNull() & F.coalesce(F.forall(vector, good), F.lit(False))


def search(df: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the best k of all other rows for each row that is_query tells.

    Every query meets every shard; a vector is sent once for each QUERIES queries, so the traffic grows with the
    product of both only beyond so many.
    """
    good = df.filter(usable(F.col(key), F.col(vector))).select(F.col(key).cast("long").alias("id"), whole(F.col(vector), scale).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = stored(good.groupBy("id").agg(F.min("vector").alias("vector"), F.max("is_query").alias("is_query")), "vectors")
    n, asked, dims = rows.agg(F.count("*"), F.count_if("is_query"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    shards, blocks = max(1, -(-n // SHARD), min(tasks, n // LEAST)), max(1, -(-asked // QUERIES))
    every = lambda m, name: F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(name)
    one = lambda m: F.pmod(F.xxhash64("id"), F.lit(m)).cast("int")
    vectors = rows.select(one(shards).alias("shard"), "id", "vector").select("shard", every(blocks, "block"), "id", "vector")
    queries = rows.filter("is_query").select(one(blocks).alias("block"), "id", "vector").select(every(shards, "shard"), "block", "id", "vector")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own, at, scores = (np.empty(0, np.int64),) * 3
        if left.num_rows and right.num_rows and dims:
            index, asking = Index(left.column("id").to_numpy(), _matrix(left.column("vector"), dims)), right.column("id").to_numpy()
            place, at, scores = index.search(_matrix(right.column("vector"), dims), asking, k)
            own = asking[place]
            del index
            release()
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), (own, at, scores))})

    best = vectors.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
