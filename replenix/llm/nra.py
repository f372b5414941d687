"""Operator 11, exact top-k search by aggregation without random access.

Vectors are scaled to integers and cut into blocks; every block keeps, per dimension, the list of its components in
order.  A query reads all lists in step from the end that raises its score (the top where its own component is
positive, the bottom where it is negative), ``Search.first`` of the rows at a time and twice as many at every further
stop.  What has been read of a candidate, and where the lists stand, bound its score from below and above; a candidate
whose upper bound is less than the k-th best lower bound is out, and a query stops reading when no more than
``Search.resolve`` candidates are left, whose final scores are then made of all their components.

Every query visits every block (a stated query set against all rows, in blocks).  Its k-th best score in one block is
a bound for all others, so the first block is searched before them.  A block and the stream of queries that visit it
are one group of a sorted partition: lists are built once, queries pass in batches.

Defined results: vectors that are null, hold null, NaN or infinite components, or have no id take no part; only
vectors of one length meet; rows that repeat an id are vectors of their own (a repeated query id has its ranks once per
row); equal scores by ascending id; a score beyond 64 bits is held at its end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replenix.llm.common import ship, stored


@dataclass(frozen=True)
class Search:
    """Bounds of the work; only ``best`` changes a result."""

    best: int = 5          # results of a query
    block: int = 4096      # rows of a block, about
    first: float = 1 / 16  # share of the rows read from every list before the first stop
    resolve: int = 20      # candidates left at which reading ends
    batch: int = 128       # queries that read together


_EXACT = {np.dtype("f4"): 2.0 ** 24, np.dtype("f8"): 2.0 ** 53}   # sums of whole numbers below these are exact


class Lists:
    """Sorted lists of one block of scaled vectors (rows x dimensions, whole numbers)."""

    def __init__(self, values: np.ndarray, ids: np.ndarray, keys: np.ndarray):
        self.values, self.ids, self.keys = values, ids, keys
        order = np.argsort(values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(values, order, axis=0)
        self.rank = np.empty(values.shape, dtype=np.int32)   # place of a component in its list, from the bottom
        np.put_along_axis(self.rank, order, np.arange(len(values), dtype=np.int32)[:, None], axis=0)
        self.largest = np.abs(values).max(axis=0, initial=0)

    def top(self, queries: np.ndarray, keys: np.ndarray, floors: np.ndarray, search: Search) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, scores) of the ``best`` candidates of every query, best first; fewer where the others stay below its floor."""
        bound = (np.abs(queries).max(axis=0, initial=0) * self.largest).sum()
        kind = next((k for k, most in _EXACT.items() if bound < most), None)
        if kind is None:
            return [self._chosen(*self._whole(q, key), search) for q, key in zip(queries, keys)]
        found: list = [None] * len(queries)
        for at, rows in self._read(queries.astype(kind), keys, floors, search, kind):
            scores = self.values[rows] @ queries[at]
            found[at] = self._chosen(rows, scores, search)
        return found

    def _read(self, queries, keys, floors, search, kind):
        """Yields (query, candidates left) as soon as a query stops reading."""
        n = len(self.values)
        rows, open_ = np.arange(n), np.arange(len(queries))
        values, bottom, top = self.values.astype(kind), self.sorted[0].astype(kind), self.sorted[-1].astype(kind)
        rank = self.rank
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        known = np.zeros((len(queries), n), dtype=kind)   # sum of what has been read
        read, depth = 0, max(1, int(n * search.first))
        while len(open_):
            depth = min(n, depth)
            from_top, from_bottom = rank >= n - depth, rank < depth
            known += up @ (values * (from_top & (rank < n - read))).T + down @ (values * (from_bottom & (rank >= read))).T
            unread_top, unread_bottom = (~from_top).astype(kind), (~from_bottom).astype(kind)
            here_top, here_bottom = (self.sorted[k].astype(kind) for k in (n - depth, depth - 1))
            least = known + (up * bottom) @ unread_top.T + (down * top) @ unread_bottom.T
            most = known + (up * here_top) @ unread_top.T + (down * here_bottom) @ unread_bottom.T
            own = self.keys[rows][None, :] == keys[open_][:, None]
            least[own] = most[own] = -np.inf
            bar = floors[open_].astype("f8")
            if len(rows) > search.best:
                bar = np.maximum(bar, np.partition(least, -search.best, axis=1)[:, -search.best])
            left = (most >= bar[:, None]) & ~own
            done = (left.sum(axis=1) <= search.resolve) | (depth == n)
            for i in np.flatnonzero(done):
                yield int(open_[i]), rows[left[i]]
            going = ~done
            open_, up, down = open_[going], up[going], down[going]
            some = left[going].any(axis=0)
            known, rows, values, rank = known[going][:, some], rows[some], values[some], rank[some]
            read, depth = depth, 2 * depth

    def _whole(self, query: np.ndarray, key: int) -> tuple[np.ndarray, np.ndarray]:
        """All candidates with their scores in whole numbers of any size."""
        rows = np.flatnonzero(self.keys != key)
        q = [int(x) for x in query]
        scores = [sum(int(x) * y for x, y in zip(row, q)) for row in self.values[rows]]
        return rows, np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in scores], dtype=np.int64)

    def _chosen(self, rows: np.ndarray, scores: np.ndarray, search: Search) -> tuple[np.ndarray, np.ndarray]:
        scores = scores.astype(np.int64)
        order = np.lexsort((self.keys[rows], self.ids[rows], ~scores))[:search.best]   # ~x falls as x grows
        return rows[order], scores[order]


_FOUND = T.StructType([T.StructField(c, T.LongType()) for c in ("query", "query_id", "key", "vec_id", "score")])


def _searching(search: Search):
    """Arrow function over partitions sorted by (dims, block, is_query, key): the best of every query in every block."""
    def work(batches):
        at, waiting, lists = None, [], None
        for batch in batches:
            dims, block, is_query, keys, ids, floors = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(6))
            values = np.floor(256 * batch.column(6).flatten().to_numpy(zero_copy_only=False).astype("f8"))
            before = np.cumsum(np.r_[0, dims])
            change = (np.diff(dims) != 0) | (np.diff(block) != 0) | (np.diff(is_query.astype("i1")) != 0)
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(dims)] if len(dims) else []
            for lo, hi in zip(edges, edges[1:]):
                part = values[before[lo]:before[hi]].reshape(hi - lo, dims[lo])
                if at != (dims[lo], block[lo]):
                    at, waiting, lists = (dims[lo], block[lo]), [], None
                if not is_query[lo]:
                    waiting.append((part, ids[lo:hi], keys[lo:hi]))
                    continue
                if lists is None and waiting:
                    lists, waiting = Lists(*(np.concatenate(x) for x in zip(*waiting))), []
                for k in range(lo, hi if lists else lo, search.batch):
                    end = min(hi, k + search.batch)
                    found = lists.top(part[k - lo:end - lo], keys[k:end], floors[k:end], search)
                    sizes = [len(rows) for rows, _ in found]
                    rows = np.concatenate([rows for rows, _ in found])
                    yield pa.record_batch(
                        [np.repeat(keys[k:end], sizes), np.repeat(ids[k:end], sizes), lists.keys[rows], lists.ids[rows],
                         np.concatenate([scores for _, scores in found])], names=_FOUND.names)
    return work


def top_k(vectors: DataFrame, is_query, search: Search = Search(), vec_id: str = "vec_id",
          embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``best`` inner products of every row for which ``is_query``.

    ``is_query`` is a condition on the id, a column or its SQL text.
    """
    spark = vectors.sparkSession
    ship(spark)
    x = F.col(f"`{embedding}`")
    whole = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), x.alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(
            "embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    condition = F.expr(is_query) if isinstance(is_query, str) else is_query
    rows = stored(whole.select(F.monotonically_increasing_id().alias("key"), "vec_id", F.size("embedding").alias("dims"),
                               F.coalesce(condition, F.lit(False)).alias("asks"), "embedding"), "vectors")
    sizes = rows.groupBy("dims").agg(F.ceil(F.count("*") / search.block).cast("int").alias("blocks"))   # a row per length
    rows = rows.join(sizes, "dims")
    none = F.lit(float("-inf"))
    shape = ["dims", "block", "is_query", "key", "vec_id", "floor", "embedding"]
    candidates = rows.select("dims", F.pmod(F.xxhash64("key"), "blocks").cast("int").alias("block"),
                             F.lit(False).alias("is_query"), "key", "vec_id", none.alias("floor"), "embedding")
    queries = rows.where("asks").withColumn("is_query", F.lit(True))

    def found(candidates: DataFrame, queries: DataFrame) -> DataFrame:
        visits = candidates.select(shape).union(queries.select(shape))
        return visits.repartition("dims", "block").sortWithinPartitions("dims", "block", "is_query", "key").mapInArrow(
            _searching(search), _FOUND)

    first = stored(found(candidates.where("block = 0"),
                         queries.withColumn("block", F.lit(0)).withColumn("floor", none)), "first-block")
    floors = first.groupBy("query").agg(F.min("score").cast("double").alias("floor"), F.count("*").alias("n"))
    floors = floors.select(F.col("query").alias("key"), F.when(F.col("n") == search.best, F.col("floor")).alias("floor"))
    visiting = queries.where("blocks > 1").join(floors, "key", "left").withColumn("floor", F.coalesce("floor", none))
    visiting = visiting.withColumn("block", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)))
    others = found(candidates.where("block > 0"), visiting)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "key")
    return (first.union(others).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= search.best)
            .select("query_id", "rank", "vec_id", "score"))
