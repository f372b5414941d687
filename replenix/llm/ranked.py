"""Operator 12, ranked lexical search: all items of a block evaluated together, what their term sets share only once.

Terms that several items share are found by mining: the two nodes (terms, or sums made before) that stand together in
most items become one new node, in all of those items, until no two nodes stand together twice.  That gives a graph of
sums.  Documents are reduced to their item terms once; a task holds the accumulators of some documents as one table
(nodes x documents), fills in the terms, adds up node by node in order of the graph, so that every shared sum is made
once, and the items last.  Each task keeps the best documents per item, of which the best of all are chosen.

Items go in blocks of ``Ranking.block_bytes`` of text, each with one pass over the documents; a block's terms and graph
are broadcast.  Collection figures (documents per term, documents, terms) are summed within the pass that reduces the
documents.

Defined results: null texts have no terms; an item without terms, or whose terms no document holds, has no rows; rows
that repeat a document or an item id are documents and items of their own; a null doc_id comes last among equal scores.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import chain, combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replenix.llm.common import ship, stored, texts

# Separators are all ASCII characters but letters and digits; only A-Z are lowered.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_NULL_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Ranking:
    """``best`` documents per item; the others bound the work and change no result."""

    best: int = 10
    block_bytes: int = 1 << 20   # item text that is evaluated together (one item at least)
    mined: int = 32              # nodes of an item that are looked at for shared pairs, the most shared ones
    cells: int = 4_000_000       # accumulators held at once


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


@dataclass
class Graph:
    """Sums that items share: rows of an accumulator table, in order of their making."""

    leaves: np.ndarray     # term of every leaf row
    times: np.ndarray      # how often the term counts
    levels: list[tuple[int, np.ndarray, np.ndarray]]   # first row of a level, rows that are added for it
    children: np.ndarray   # rows that are added for the items, one item after the other
    starts: np.ndarray
    rows: int

    def sums(self, table: np.ndarray) -> np.ndarray:
        """Items x documents from a table whose leaf rows are filled in."""
        for first, one, two in self.levels:
            np.add(table[one], table[two], out=table[first:first + len(one)])
        return np.add.reduceat(table[self.children], self.starts, axis=0)


def shared_sums(items: list[Counter], mined: int) -> Graph:
    """The graph of items given as term number -> occurrences (one term at least)."""
    leaf: dict[tuple[int, int], int] = {}
    sets = [{leaf.setdefault((t, n), len(leaf)) for t, n in sorted(item.items())} for item in items]
    rows, levels = len(leaf), []
    holders: dict[int, set[int]] = {}
    for i, nodes in enumerate(sets):
        for node in nodes:
            holders.setdefault(node, set()).add(i)
    while True:
        together: Counter = Counter()
        for nodes in sets:
            often = sorted((n for n in nodes if len(holders[n]) > 1), key=lambda n: (-len(holders[n]), n))[:mined]
            together.update(combinations(sorted(often), 2))
        pairs, used = [], set()
        for (x, y), n in sorted(together.items(), key=lambda p: (-p[1], p[0])):
            if n > 1 and x not in used and y not in used:
                used |= {x, y}
                pairs.append((x, y))
        if not pairs:
            break
        for k, (x, y) in enumerate(pairs):
            both = holders[x] & holders[y]
            holders[rows + k] = both
            holders[x], holders[y] = holders[x] - both, holders[y] - both
            for i in both:
                sets[i] -= {x, y}
                sets[i].add(rows + k)
        levels.append((rows, *(np.array(side, dtype=np.int64) for side in zip(*pairs))))
        rows += len(pairs)
    children = [sorted(nodes) for nodes in sets]
    return Graph(np.array([t for t, _ in leaf], dtype=np.int64), np.array([n for _, n in leaf], dtype=np.int64), levels,
                 np.array([c for cs in children for c in cs], dtype=np.int64),
                 np.cumsum([0, *map(len, children)])[:-1], rows)


class _Best:
    """The best documents of every item that a task has seen."""

    def __init__(self, items: int, best: int):
        self.best, self.bar = best, np.ones(items, dtype=np.int64)   # scores from which a document counts
        self.kept = [np.empty(0, dtype=np.int64)] * 3                # item, score, doc_id
        self.waiting: list[tuple] = []
        self.held = 0

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of all items (rows) and some documents (columns)."""
        item, doc = np.nonzero(scores >= self.bar[:, None])
        self.waiting.append((item, scores[item, doc], ids[doc]))
        self.held += len(item)
        if self.held > 4 * self.best * len(self.bar):
            self.choose()

    def choose(self) -> None:
        item, score, doc = (np.concatenate(x) for x in zip(self.kept, *self.waiting))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        first = np.searchsorted(item, item)
        place = np.arange(len(item)) - first
        last = place == self.best - 1
        self.bar[item[last]] = score[last]
        self.kept = [x[place < self.best] for x in (item, score, doc)]
        self.waiting, self.held = [], 0


def _postings(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """A written table: documents that hold item terms (doc_id, n terms, their item terms and occurrences), and one row
    per task without ``n`` that sums up documents, terms, and documents per item term."""
    spark = docs.sparkSession
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("terms", ints),
                           T.StructField("times", ints), T.StructField("docs", T.LongType()), T.StructField("length", T.LongType())])
    shipped, size = spark.sparkContext.broadcast(vocabulary), len(vocabulary)

    def reduce(batches):
        get, df = shipped.value.get, np.zeros(size, dtype=np.int64)
        documents = length = 0
        for batch in batches:
            words = [terms(t) for t in texts(batch)]
            n = np.array([len(w) for w in words], dtype=np.int64)
            found = np.fromiter(map(get, chain.from_iterable(words), repeat(-1)), dtype=np.int64, count=int(n.sum()))
            order = (np.repeat(np.arange(len(n)), n) * size + found)[found >= 0]
            order.sort()
            heads = np.flatnonzero(np.r_[True, order[1:] != order[:-1]][:len(order)])
            doc, term, times = order[heads] // size, order[heads] % size, np.diff(np.r_[heads, len(order)])
            df += np.bincount(term, minlength=size)
            documents, length = documents + int((n > 0).sum()), length + int(n.sum())
            some, at = np.unique(doc, return_index=True)
            offsets = pa.array(np.r_[at, len(doc)].astype("i4"))
            none = pa.nulls(len(some), pa.int64())
            yield pa.record_batch([batch.column(0).take(pa.array(some)), pa.array(n[some]),
                                   *(pa.ListArray.from_arrays(offsets, pa.array(x.astype("i4"))) for x in (term, times)),
                                   none, none], names=schema.names)
        held = np.flatnonzero(df)
        none = pa.nulls(1, pa.int64())
        yield pa.record_batch([none, none, pa.array([held.astype("i4")], pa.list_(pa.int32())),
                               pa.array([df[held].astype("i4")], pa.list_(pa.int32())), pa.array([documents], pa.int64()),
                               pa.array([length], pa.int64())], names=schema.names)

    return stored(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
                  .mapInArrow(reduce, schema), "item-postings")


_RANKED = "item bigint, doc_id bigint, score bigint"


def _ranked(docs: DataFrame, items: list[Counter], ranking: Ranking, doc_id: str, text: str) -> DataFrame:
    """item (position in ``items``), doc_id and score: the best documents of every task."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    numbered = [Counter({vocabulary.setdefault(t, len(vocabulary)): n for t, n in sorted(i.items())}) for i in items]
    postings = _postings(docs, vocabulary, doc_id, text)
    whole = postings.where("n is null")
    documents, length = whole.agg(F.sum("docs"), F.sum("length")).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    held = whole.select(F.explode(F.arrays_zip("terms", "times")).alias("x")).groupBy("x.terms").agg(F.sum("x.times").alias("df"))
    for r in held.collect():   # a row per term of the block
        df[r.terms] = r.df
    weights = np.array([math.floor(1000 * math.log((2 * (documents or 0) + 2) / (2 * n + 1))) for n in df.tolist()], dtype=np.int64)
    graph = spark.sparkContext.broadcast(shared_sums(numbered, ranking.mined))

    def score(batches):
        g, best = graph.value, _Best(len(numbered), ranking.best)
        step = max(1, ranking.cells // max(1, g.rows + len(g.children)))
        of_term = np.argsort(g.leaves, kind="stable")       # leaf rows by term
        first = np.searchsorted(g.leaves[of_term], np.arange(len(weights) + 1))
        for batch in batches:
            ids = batch.column(0).fill_null(_NULL_ID).to_numpy()
            n, offsets = batch.column(1).to_numpy(), batch.column(2).offsets.to_numpy()
            term, times = (batch.column(k).values.to_numpy().astype(np.int64) for k in (2, 3))
            norm = 25 + 75 * n * documents // length
            for lo in range(0, len(n), step):
                hi = min(len(n), lo + step)
                at = slice(offsets[lo], offsets[hi])
                doc = np.repeat(np.arange(hi - lo), np.diff(offsets[lo:hi + 1]))
                t, tf = term[at], times[at]
                impact = weights[t] * (1_000_000_000 * tf // (1000 * tf + 8 * norm[lo:hi][doc]))
                rows = first[t + 1] - first[t]     # a term is a leaf once per number of times that items count it
                spread = np.repeat(np.arange(len(t)), rows)
                leaf = of_term[np.repeat(first[t] - np.r_[0, np.cumsum(rows)[:-1]], rows) + np.arange(len(spread))]
                table = np.zeros((g.rows, hi - lo), dtype=np.int64)
                table[leaf, doc[spread]] = impact[spread] * g.times[leaf]
                best.add(g.sums(table), ids[lo:hi])
        best.choose()
        item, found, doc = best.kept
        yield pa.record_batch([pa.array(item), pa.array(doc, mask=doc == _NULL_ID), pa.array(found)],
                              names=["item", "doc_id", "score"])

    return postings.where("n is not null").select("doc_id", "n", "terms", "times").mapInArrow(score, _RANKED)


def ranked(docs: DataFrame, items: DataFrame, ranking: Ranking = Ranking(), doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the best documents of every item row."""
    spark = docs.sparkSession
    ship(spark)
    kept = stored(items.select(F.monotonically_increasing_id().alias("key"), F.col(f"`{item_id}`").alias("item_id"),
                               F.col(f"`{item_text}`").alias("text")), "items")
    size = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // ranking.block_bytes))
    found = spark.createDataFrame([], f"key bigint, {_RANKED}")
    for k in range(blocks):   # each of bounded size
        block = [(r.key, Counter(terms(r.text.encode()))) for r in
                 kept.where((F.pmod(F.xxhash64("key"), F.lit(blocks)) == k) & F.col("text").isNotNull()).select("key", "text").collect()]
        block = [(key, counted) for key, counted in block if counted]
        if block:
            scored = _ranked(docs, [counted for _, counted in block], ranking, doc_id, text)
            named = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(block)], "item bigint, key bigint")
            found = found.union(scored.join(named, "item").select("key", "item", "doc_id", "score"))
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranking.best)
    return best.join(kept.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")
