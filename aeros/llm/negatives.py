"""Hard-negative mining by threshold joins over inverted lists in the manner of L2AP.

A shard of integer vectors has an inverted list for each dimension, in layers. A vector's components are taken from the
largest down; a layer holds the postings that bring the norm of what the lists still omit of each vector below the layer's
level. For an anchor q the lists opened so far give each vector a partial score; what they omit adds at most the omitted
norm times q's norm. So a vector of which the lists hold nothing yet cannot reach a threshold above that product, and the
lists of smaller components are opened only for lower thresholds.

Positives: an anchor's best scores among the rows of its label. Leaders scored exactly set the threshold; lists are opened until
few others can reach it, and those are scored exactly. Negatives: for each positive a window of scores, [30 %, 90 %] of
the positive's by default, among the rows of other labels. The threshold begins just below the window's upper end and is lowered
until the window is full or its lower end is reached; at each threshold all rows whose bounds reach into the window are
scored exactly in integers. The shards' results meet for each anchor, and for each anchor and positive.

Rows with a null id, label or vector, or with null or non-finite components, take no part. Rows that repeat an id are one row,
with the smallest of (vector, label); it is an anchor if one of them is. Shorter vectors count as padded with zeros. Ties go to the
smaller id. A positive with a negative score has an empty window. An anchor without positives, and a window without rows, give
no rows; empty tables give none. Other columns play no part. Scores must fit a long, and norms 2^52.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release, stored
from .topk import _matrix, usable, whole

#: Components of a shard at most, vectors of a shard at least (where there are tasks enough), anchors of a block.
CELLS, LEAST, ANCHORS = 1 << 21, 2048, 16_384
#: Norm that the lists omit of a vector after each layer, as a share of the largest norm.
LEVELS = (0.5, 0.36, 0.27, 0.2, 0.14, 0.09, 0.0)
#: A layer is opened while more than one in FEW rows would have to be scored exactly.
FEW = 8
#: First and later shares of a window by which the threshold is lowered.
LOWER = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 1.0)


class Lists:
    """Layered inverted lists over the rows of a shard, in order of their ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], vectors[order].astype(np.int64)
        size = self.x.astype(np.float64)
        by_size = np.argsort(-np.abs(size), axis=1, kind="stable")
        ranked = np.take_along_axis(size, by_size, 1)
        left = np.sqrt(np.cumsum((ranked * ranked)[:, ::-1], axis=1)[:, ::-1])  # norm of a vector's components from each rank on
        self.norms = left[:, 0] if left.shape[1] else np.zeros(len(ids))
        self.left = np.concatenate([left, np.zeros((len(ids), 1))], axis=1)
        top = float(self.norms.max(initial=0.0))
        self.layers, self.rest, taken = [], [], np.zeros(len(ids), np.int64)
        for level in LEVELS:
            upto = (left > level * top).sum(axis=1) if left.shape[1] else taken
            rank = np.arange(left.shape[1])[None, :]
            row, at = np.nonzero((rank >= taken[:, None]) & (rank < upto[:, None]))
            dim = by_size[row, at]
            by_dim = np.argsort(dim, kind="stable")  # a list for each dimension, its rows in order of their ids
            self.layers.append((row[by_dim].astype(np.int32), dim[by_dim].astype(np.int32), ranked[row, at][by_dim]))
            self.rest.append(self.left[np.arange(len(ids)), upto])
            taken = upto
        self.opened = self.scored = 0

    def exact(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        self.scored += len(at)
        return (self.x[at] * q).sum(axis=1)


class Partial:
    """The scores of one anchor against a shard, as far as its lists are open, and those known exactly."""

    def __init__(self, lists: Lists, q: np.ndarray):
        self.lists, self.q, self.real = lists, q.astype(np.int64), q.astype(np.float64)
        self.norm = float(np.sqrt((self.real * self.real).sum()))
        n = len(lists.ids)
        self.sum, self.level = np.zeros(n), 0
        self.known, self.score = np.zeros(n, bool), np.zeros(n, np.int64)
        self.open()

    def open(self) -> None:
        """Take the next layer of lists."""
        row, dim, value = self.lists.layers[self.level]
        self.lists.opened += len(row)
        if len(row):
            self.sum += np.bincount(row, self.real[dim] * value, len(self.sum))
        # the small share covers rounding
        self.slack = self.norm * (self.lists.rest[self.level] + 1e-9 * self.lists.norms) + 1e-6
        self.level += 1

    @property
    def ended(self) -> bool:
        return self.level == len(self.lists.layers)

    def settle(self, at: np.ndarray) -> None:
        """Score these rows exactly."""
        at = at[~self.known[at]]
        if len(at):
            self.score[at] = self.lists.exact(self.q, at)
            self.known[at] = True

    def best(self, fits: np.ndarray, k: int) -> np.ndarray:
        """The places of the best k of the rows that fit."""
        own = np.flatnonzero(fits)
        lead = min(2 * k, len(own))
        while len(own) > k:
            leaders = own[np.argpartition(-self.sum[own], lead - 1)[:lead]]
            self.settle(leaders)
            threshold = np.partition(self.score[own[self.known[own]]], -k)[-k]
            own = own[(self.sum[own] + self.slack[own] >= threshold) | (self.known[own] & (self.score[own] >= threshold))]
            if self.ended or len(own) <= max(4 * k, len(self.sum) // FEW):
                break
            lead = min(lead, len(own))
            self.open()
        self.settle(own)
        return own[np.lexsort((self.lists.ids[own], -self.score[own]))[:k]]

    def window(self, fits: np.ndarray, low: int, high: int, k: int) -> np.ndarray:
        """The places of the first k of the fitting rows with scores from low to high."""
        if low > high:
            return np.empty(0, np.int64)
        for share in LOWER:
            threshold = max(low, int(np.floor(high - share * (high - low)))) if share < 1 else low
            while True:
                reach = np.flatnonzero(fits & (self.sum + self.slack >= threshold) & (self.sum - self.slack <= high) & ~self.known)
                if self.ended or len(reach) * FEW <= len(self.sum):
                    break
                self.open()
            self.settle(reach)
            own = np.flatnonzero(fits & self.known & (self.score >= threshold) & (self.score <= high))
            if len(own) >= k or threshold == low:
                return own[np.lexsort((self.lists.ids[own], -self.score[own]))[:k]]
        raise AssertionError("the last threshold is the window's lower end")


def _rows(df: DataFrame, is_anchor: Column, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    good = df.filter(usable(F.col(f"`{key}`"), F.col(f"`{vector}`")) & label.isNotNull())
    own = good.select(F.col(f"`{key}`").cast("long").alias("id"), F.struct(whole(F.col(f"`{vector}`"), scale).alias("vector"), label.cast("long").alias("label")).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    return own.groupBy("id").agg(F.min("v").alias("v"), F.max("is_anchor").alias("is_anchor")).select("id", "v.label", "v.vector", "is_anchor")


def mined(df: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 10, band: tuple[int, int] = (30, 90), key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its best positives
    the best negatives whose score is from band[0] to band[1] hundredths of the positive's.

    Every anchor meets every shard; a vector is sent once for each ANCHORS anchors.
    """
    rows = stored(_rows(df, is_anchor, key, vector, label, scale), "vectors")
    n, asked, dims = rows.agg(F.count("*"), F.count_if("is_anchor"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    shards, blocks = max(1, -(-n * max(1, dims) // CELLS), min(tasks, n // LEAST)), max(1, -(-asked // ANCHORS))
    every = lambda m, name: F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(name)
    one = lambda m: F.pmod(F.xxhash64("id"), F.lit(m)).cast("int")
    vectors = rows.select(one(shards).alias("shard"), "id", "label", "vector").select("shard", every(blocks, "block"), "id", "label", "vector")
    anchors = rows.filter("is_anchor").select(one(blocks).alias("block"), "id", "label", "vector")
    spread = lambda a: a.select(every(shards, "shard"), "*").groupBy("shard", "block")
    place = ("id", "label", "vector")

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows and dims:
            ids, labels = left.column("id").to_numpy(), left.column("label").to_numpy()
            x = _matrix(left.column("vector"), dims)
            q, asking, wanted = _matrix(right.column("vector"), dims), right.column("id").to_numpy(), right.column("label").to_numpy()
            for own in np.unique(wanted):
                here = labels == own
                lists = Lists(ids[here], labels[here], x[here])
                for i in np.flatnonzero(wanted == own) if here.any() else ():
                    at = (part := Partial(lists, q[i])).best(lists.ids != asking[i], positives)
                    out += zip([int(asking[i])] * len(at), lists.ids[at].tolist(), part.score[at].tolist())
            release()
        columns = list(zip(*out)) if out else [()] * 3
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("anchor_id", "positive_id", "positive_score"), columns)})

    best = vectors.groupBy("shard", "block").cogroup(spread(anchors)).applyInArrow(find_positives, "anchor_id long, positive_id long, positive_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    own = best.withColumn("rank", rank).filter(F.col("rank") <= positives).groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("own"))
    asking = stored(anchors.join(own, anchors["id"] == own["anchor_id"]).select("block", *place, "own.positive_id", "own.positive_score"), "positives")

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, ...]] = []
        if left.num_rows and right.num_rows and dims:
            lists = Lists(left.column("id").to_numpy(), left.column("label").to_numpy(), _matrix(left.column("vector"), dims))
            q = _matrix(right.column("vector"), dims)
            for i, (anchor, label_, ids, scores) in enumerate(zip(*(right.column(c).to_pylist() for c in ("id", "label", "positive_id", "positive_score")))):
                part, fits = Partial(lists, q[i]), lists.labels != label_
                for positive, score in sorted(zip(ids, scores), key=lambda p: -p[1]):
                    at = part.window(fits, -(-band[0] * score // 100), band[1] * score // 100, negatives)
                    out += zip([anchor] * len(at), [positive] * len(at), lists.ids[at].tolist(), [score] * len(at), part.score[at].tolist())
            del lists
            release()
        columns = list(zip(*out)) if out else [()] * 5
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"), columns)})

    found = vectors.groupBy("shard", "block").cogroup(spread(asking)).applyInArrow(find_negatives, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
