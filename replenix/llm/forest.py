"""Operator 7, near-duplicates: MinHash LSH forest.

The set of a document is its distinct five-word shingles (64-bit hashes).  Equal sets form one class.  Every class
gets a MinHash signature; each of 16 trees sorts the classes by its own order of the signature's parts.  Classes
that agree on the first two parts of an order are a region, and all pairs of a region are looked at: a sketch of the
whole signature tells the candidates among them.  A region of up to ``most`` classes inside one sorted range is
looked at there.  In a larger one, near neighbours (read one part deeper, again and again) and one leading class are
looked at first.  Of the candidates of a region only a spanning forest of the nearest is kept, at most one pair per
class and order.  Classes of large regions, and of regions that the end of a range may cut, are met whole after that:
what is connected already is one component, and every class outside the region's largest component meets every class
of another component, in blocks of ``most`` classes.  A block pair gives links between components only.

The candidates are confirmed on the full sets.  Only connections count, so classes that candidates connect form a
cluster, and a cluster is settled exactly: every pair of its sets across components is compared.  Clusters of up to
``block`` classes are settled in one task.  In a larger one, three near neighbours of every class are confirmed
first, which leaves one large component and a few others; only those others meet everything else, block by block.

Defined results: null and wordless texts have an empty set and are linked with nothing; a text of one to four words
has its word sequence as its only shingle; rows that share a doc_id are one document; a null doc_id stays alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replenix.llm.common import ship, stored, texts
from replenix.llm.components import components

WORDS = 5
_RANGE_ROWS = 1 << 20   # rows of a sorted range, which one task holds, about


@dataclass(frozen=True)
class Forest:
    """Shape of the forest; ``percent`` is the similarity from which two sets are linked."""

    percent: int = 75
    trees: int = 16
    own: int = 8            # hash functions per tree (128 in all)
    long_parts: int = 4     # parts of an order that are kept with 32 bits; the others have 8
    short_parts: int = 8
    first: int = 2          # parts on which a region agrees at least
    most: int = 1024        # classes of a region that is looked at where it lies; larger ones meet in blocks of so many
    nearest: int = 3        # near neighbours of a class that are named in a large region
    block: int = 512        # classes of a cluster that one task compares
    slack: float = 5.2      # standard deviations that a sketch may fall short of the similarity
    seed: int = 5

    @property
    def hashes(self) -> int:
        return self.trees * self.own

    @property
    def least_equal(self) -> int:
        """Equal 4-bit parts of two sketches from which a pair is a candidate."""
        j = self.percent / 100
        p = j + (1 - j) / 16
        return int(self.hashes * p - self.slack * (self.hashes * p * (1 - p)) ** 0.5)


def shingle_sets(batch: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text."""
    import xxhash

    split = [t.lower().split() for t in batch]   # bytes: A-Z and the six white-space bytes only
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(w) for words in split for w in words), dtype=np.uint64, count=int(sizes.sum()))
    mix, out, start = np.uint64(0x9E3779B97F4A7C15), [], 0
    with np.errstate(over="ignore"):
        if len(hashes) >= WORDS:
            fives = hashes[: len(hashes) - WORDS + 1].copy()
            for k in range(1, WORDS):
                fives = fives * mix + hashes[k: len(hashes) - WORDS + 1 + k]
            fives ^= fives >> np.uint64(29)
            fives *= np.uint64(0xBF58476D1CE4E5B9)
        for n in sizes.tolist():
            if n >= WORDS:
                out.append(np.unique(fives[start:start + n - WORDS + 1]))
            elif n:
                short = np.uint64(n)
                for h in hashes[start:start + n]:
                    short = short * mix + h
                out.append(np.array([short * np.uint64(0x94D049BB133111EB)], dtype=np.uint64))
            else:
                out.append(np.empty(0, dtype=np.uint64))
            start += n
    return out


def _signatures(sets: list[np.ndarray], forest: Forest) -> np.ndarray:
    """32-bit MinHash values, one row per (non-empty) set."""
    rng = np.random.default_rng(forest.seed)
    factors = rng.integers(1, 1 << 63, forest.hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    joined = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets])[:-1]
    out = np.empty((len(sets), forest.hashes), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for i, f in enumerate(factors):
            x = joined * f
            x ^= x >> np.uint64(32)
            out[:, i] = np.minimum.reduceat((x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32), starts)
    return out


def signed(docs: DataFrame, forest: Forest, doc_id: str, text: str) -> DataFrame:
    """doc_id, n_shingles, class_key (128-bit hash of the set), labels (one per tree) and sketch."""
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
                           T.StructField("class_key", T.BinaryType()), T.StructField("labels", T.BinaryType()),
                           T.StructField("sketch", T.BinaryType())])

    def sign(batches):
        import xxhash

        for batch in batches:
            sets = shingle_sets(texts(batch))
            some = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            labels, sketches = keys.copy(), keys.copy()
            if some:
                values = _signatures([sets[i] for i in some], forest)
                low = (values & 15).astype(np.uint8)
                packed = low[:, ::2] << 4 | low[:, 1::2]
                big = values.astype(">u4")
                short = (values >> 8).astype(np.uint8)
                parts = []
                for t in range(forest.trees):
                    order = (t * forest.own + np.arange(forest.long_parts + forest.short_parts)) % forest.hashes
                    head, tail = order[:forest.long_parts], order[forest.long_parts:]
                    parts += [np.ascontiguousarray(big[:, head]).view(np.uint8), short[:, tail]]
                table = np.concatenate(parts, axis=1)
                for row, i in enumerate(some):
                    keys[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                    labels[i], sketches[i] = table[row].tobytes(), packed[row].tobytes()
            yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                                   pa.array(keys, pa.binary()), pa.array(labels, pa.binary()),
                                   pa.array(sketches, pa.binary())], names=schema.names)

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")
                       ).mapInArrow(sign, schema)


def _sorted_orders(classes: DataFrame, forest: Forest, *extra: str) -> DataFrame:
    """One row per class and tree, sorted within ascending ranges of (tree, label)."""
    width = 4 * forest.long_parts + forest.short_parts
    rows = classes.select(F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))).alias("tree"), "id", "labels",
                          "sketch", *extra)
    return rows.select("tree", F.expr(f"substring(labels, tree * {width} + 1, {width})").alias("label"), "id",
                       "sketch", *extra)


_EQUAL = np.array([(b >> 4 == 0) + (b & 15 == 0) for b in range(256)], dtype=np.uint8)

_FOUND = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                       T.StructField("equal", T.IntegerType()), T.StructField("tree", T.IntegerType()),
                       T.StructField("region", T.BinaryType()), T.StructField("id", T.LongType())])


class _Rows:
    """Sorted rows of one range, as arrays."""

    def __init__(self, table: pa.Table, forest: Forest):
        table = table.combine_chunks()
        n = self.n = table.num_rows
        self.tree = table.column("tree").to_numpy()
        self.ids = table.column("id").to_numpy()
        width = 4 * forest.long_parts + forest.short_parts
        label, self.sketch = (np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=np.uint8).reshape(n, size)
                              for c, size in (("label", width), ("sketch", forest.hashes // 2)))
        self.regions = label[:, :4 * forest.first]
        long = 4 * forest.long_parts
        parts = np.concatenate([label[:, :long].view(np.uint32).astype(np.int64), label[:, long:]], axis=1)
        # depth[i]: parts that row i and row i + 1 have in common (0 across trees)
        same = (parts[1:] == parts[:-1]) & (self.tree[1:] == self.tree[:-1])[:, None]
        self.depth = np.minimum.accumulate(same, axis=1).sum(axis=1) if n > 1 else np.empty(0, dtype=np.int64)
        self.deepest = parts.shape[1]

    def equal(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i), dtype=np.int32)
        for k in range(0, len(i), 1 << 16):
            at = slice(k, k + (1 << 16))
            out[at] = _EQUAL[self.sketch[i[at]] ^ self.sketch[j[at]]].sum(axis=1)
        return out

    def runs(self, lo: int, hi: int, depth: int) -> list[tuple[int, int]]:
        """Runs of at least two rows within [lo, hi) that agree on ``depth`` parts."""
        cuts = np.flatnonzero(self.depth[lo:hi - 1] < depth) + lo + 1
        edges = [lo, *cuts.tolist(), hi]
        return [(a, b) for a, b in zip(edges, edges[1:]) if b - a > 1]


def _labelled(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row that each of ``n`` rows reaches over the edges (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _nearest_forest(n: int, i: np.ndarray, j: np.ndarray, equal: np.ndarray) -> np.ndarray:
    """Edges of a spanning forest of the edges (i, j) of ``n`` rows, most equal first: every row keeps its nearest.

    Every set of connected rows takes its best edge to another set, until no edge joins two sets.
    """
    place = np.empty(len(i), dtype=np.int64)   # of an edge among all, so that no two are alike
    by_place = np.argsort(-equal.astype(np.int64), kind="stable")
    place[by_place] = np.arange(len(i))
    label, going, chosen = np.arange(n), np.arange(len(i)), [np.empty(0, dtype=np.int64)]
    while True:
        one, two = label[i[going]], label[j[going]]
        joins = one != two
        going, one, two = going[joins], one[joins], two[joins]
        if not len(going):
            return np.concatenate(chosen)
        best = np.full(n, len(i))
        np.minimum.at(best, one, place[going])
        np.minimum.at(best, two, place[going])
        new = by_place[np.unique(best[best < len(i)])]
        chosen.append(new)
        label = _labelled(n, np.concatenate([i[new], np.arange(n)]), np.concatenate([j[new], label]))


def _neighbours(rows: _Rows, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate pairs (row numbers, equal sketch parts) that connect what was found of every region.

    Of a region of up to 8 rows these are all its candidates; of one of up to ``most`` rows the nearest forest of all its
    candidates.  Of a larger one they connect only what next neighbours at every depth and a leading row find;
    its other pairs are looked at in blocks (``_met``).
    """
    first, second, equals = [], [], []

    def candidates(i, j):
        found = rows.equal(i, j)
        at = np.flatnonzero(found >= forest.least_equal)
        return i[at], j[at], found[at]

    def add(i, j, found):
        first.append(i), second.append(j), equals.append(found)

    def add_forest(a, b, i, j, found):
        kept = _nearest_forest(b - a, i - a, j - a, found)
        add(i[kept], j[kept], found[kept])

    def seen_of(a, b):
        """Next neighbours in the order and one row for all, then one part deeper."""
        stack = [(a, b, forest.first)]
        for a, b, depth in stack:
            for o in range(1, min(forest.nearest, b - a - 1) + 1):
                yield np.arange(a, b - o), np.arange(a + o, b)
            lead = int(a + np.argmin(rows.ids[a:b]))
            others = np.setdiff1d(np.arange(a, b), [lead])
            yield np.full(len(others), lead), others
            if depth < rows.deepest:
                stack += [(x, y, depth + 1) for x, y in rows.runs(a, b, depth + 1)]

    small = np.zeros(rows.n, dtype=bool)   # row i and row i + 1 lie in one region of few rows
    for a, b in rows.runs(0, rows.n, forest.first) if rows.n > 1 else []:
        if b - a <= 8:
            small[a:b - 1] = True
        elif b - a <= forest.most:
            i, j = np.triu_indices(b - a, 1)
            add_forest(a, b, *candidates(i + a, j + a))
        else:
            found = [candidates(i, j) for i, j in seen_of(a, b)]
            add_forest(a, b, *(np.concatenate(x) for x in zip(*found)))
    together = small.copy()
    for o in range(1, 8):
        i = np.flatnonzero(together[: rows.n - o])
        if len(i):
            add(*candidates(i, i + o))
        together &= np.r_[small[o:], np.zeros(min(o, rows.n), dtype=bool)]
    none = np.empty(0, dtype=np.int64)
    return tuple(np.concatenate(x) if x else none for x in (first, second, equals))


def _candidates(forest: Forest):
    """Arrow function over one sorted range: candidate pairs, and the rows of regions that are not settled by them.

    Those are all rows of regions of more than ``most`` rows, and of the first and the last region of the range,
    which may go on in the next one.
    """
    def search(batches):
        batches = list(batches)
        rows = _Rows(pa.Table.from_batches(batches), forest) if batches else None
        if rows is None or not rows.n:
            return
        i, j, equal = _neighbours(rows, forest)
        none = pa.nulls(len(i))
        yield pa.record_batch([pa.array(np.minimum(rows.ids[i], rows.ids[j])), pa.array(np.maximum(rows.ids[i], rows.ids[j])),
                               pa.array(equal.astype("i4")), none.cast(pa.int32()), none.cast(pa.binary()),
                               none.cast(pa.int64())], names=_FOUND.names)
        cuts = np.flatnonzero(np.r_[True, rows.depth < forest.first, True])
        sizes = np.diff(cuts)
        open_ = sizes > forest.most
        open_[[0, -1]] = True
        at = np.flatnonzero(np.repeat(open_, sizes))
        none = pa.nulls(len(at))
        yield pa.record_batch([none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int32()),
                               pa.array(rows.tree[at].astype("i4")), pa.array([r.tobytes() for r in rows.regions[at]], pa.binary()),
                               pa.array(rows.ids[at])], names=_FOUND.names)
    return search


def _unequal(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """4-bit parts in which the sketches (as 64-bit words) of every row of ``one`` and of ``two`` differ."""
    out = np.zeros((len(one), len(two)), dtype=np.uint16)
    for k in range(one.shape[1]):
        x = one[:, k, None] ^ two[None, :, k]
        x |= x >> np.uint64(2)
        x |= x >> np.uint64(1)
        x &= np.uint64(0x1111111111111111)
        out += np.bitwise_count(x)
    return out


def _met(sketches: np.ndarray, component: np.ndarray, blocks: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates (row, row, equal) that connect what candidates connect across components, in one block or between two."""
    two = blocks.min() != blocks.max()
    left = np.flatnonzero(blocks == blocks.min())
    right = np.flatnonzero(blocks == blocks.max())
    words = np.zeros((len(sketches), -(-sketches.shape[1] // 8) * 8), dtype=np.uint8)
    words[:, :sketches.shape[1]] = sketches
    words = words.view(np.uint64)
    label, others = np.unique(component, return_inverse=True)[1], words[right]
    first, second, equals = [], [], []
    for lo in range(0, len(left), 64):
        part = left[lo:lo + 64]
        equal = forest.hashes - _unequal(words[part], others).astype(np.int32)
        near = (equal >= forest.least_equal) & (label[part][:, None] != label[right][None, :])
        for k in np.flatnonzero(near.any(axis=1)).tolist():
            i, met = int(part[k]), np.flatnonzero(near[k])
            found, heads = np.unique(label[right[met]], return_index=True)
            new = found != label[i]      # some are one component by now
            if new.any():
                ends = met[heads[new]]
                first += [i] * len(ends)
                second += right[ends].tolist()
                equals += equal[k, ends].tolist()
                joined = np.r_[found, label[i]]
                label[np.isin(label, joined)] = joined.min()
    return np.array(first, dtype=np.int64), np.array(second, dtype=np.int64), np.array(equals, dtype="i4")


def _tasks(rows: DataFrame, group: list[str], block: int) -> DataFrame:
    """``rows`` (id, component and the columns of ``group``) per task (group, x, y) in which they meet, with their block.

    Groups of one component have no task.  A group of up to ``block`` rows is one.  In a larger one, rows outside the
    largest component make the blocks 0 .. n - 1, those inside the blocks after them; block x < n meets every y >= x.
    """
    sizes = rows.groupBy(*group, "component").agg(F.count("*").alias("n"))
    whole = sizes.groupBy(*group).agg(F.sum("n").alias("n"), F.max("n").alias("most"),
                                      F.max_by("component", F.struct("n", "component")).alias("main"))
    rows = rows.join(whole.where("most < n"), group).withColumns({
        "outer": F.ceil((F.col("n") - F.col("most")) / block).cast("int"),
        "inner": F.ceil(F.col("most") / block).cast("int"), "h": F.xxhash64("id")})
    outside = F.col("component") != F.col("main")
    zero = F.lit(0)
    rows = rows.withColumn("block", F.when(F.col("n") <= block, zero).when(outside, F.pmod("h", "outer").cast("int"))
                           .otherwise(F.col("outer") + F.pmod("h", "inner").cast("int")).cast("int"))
    ones = F.when(outside, F.transform(F.sequence(F.col("block"), F.col("outer") + F.col("inner") - 1),
                                       lambda y: F.struct(F.col("block").alias("x"), y.alias("y"))))
    others = F.when(F.col("block") > 0, F.transform(F.sequence(zero, F.least("block", F.col("outer")) - 1),
                                                    lambda x: F.struct(x.alias("x"), F.col("block").alias("y"))))
    none = F.array().cast("array<struct<x:int,y:int>>")
    task = F.when(F.col("n") <= block, F.array(F.struct(zero.alias("x"), zero.alias("y")))).otherwise(
        F.concat(F.coalesce(ones, none), F.coalesce(others, none)))
    return rows.select(*group, "id", "component", "block", F.explode(task).alias("task")).select(
        *group, "id", "component", "block", "task.x", "task.y")


def _pairs(heads: DataFrame, forest: Forest) -> tuple[DataFrame, DataFrame]:
    """Distinct candidate pairs (a < b) with their sketch agreement, and the cluster of every class that has one."""
    spark = heads.sparkSession
    rows = heads.count() * forest.trees
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // _RANGE_ROWS))
    ordered = (_sorted_orders(heads, forest).repartitionByRange(ranges, "tree", "label", "id")
               .sortWithinPartitions("tree", "label", "id"))
    found = stored(ordered.mapInArrow(_candidates(forest), _FOUND), "candidates")
    near = stored(found.where("a is not null").groupBy("a", "b").agg(F.max("equal").alias("equal")), "near")
    placed = stored(components(near).select(F.col("node").alias("id"), "component"), "connected")

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint8).reshape(table.num_rows, -1)
        ids, component, block = (table.column(c).to_numpy() for c in ("id", "component", "block"))
        i, j, equal = _met(sketches, component, block, forest)
        i, j = np.where(ids[i] < ids[j], i, j), np.where(ids[i] < ids[j], j, i)
        return pa.table({"a": ids[i], "b": ids[j], "equal": equal, "of_a": component[i], "of_b": component[j]})

    rows = (found.where("id is not null").select("tree", "region", "id").join(placed, "id", "left")
            .withColumn("component", F.coalesce("component", "id")))
    tasks = _tasks(stored(rows, "open-regions"), ["tree", "region"], forest.most)
    met = stored(tasks.join(heads.select("id", "sketch"), "id").groupBy("tree", "region", "x", "y")
                 .applyInArrow(meet, "a long, b long, equal int, of_a long, of_b long").distinct(), "met")
    joined = components(met.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))).select(
        F.col("node").alias("component"), F.col("component").alias("joined"))
    single = met.select(F.col("a").alias("id"), F.col("of_a").alias("component")).union(met.select("b", "of_b")).where("id = component")
    clusters = (placed.union(single).distinct().join(joined, "component", "left")
                .select("id", F.coalesce("joined", "component").alias("cluster")))
    return near.union(met.select("a", "b", "equal")), clusters


def _similar(common, one, two, percent: int):
    return 100 * common >= percent * (one + two - common)


def _confirmed(pairs: DataFrame, members: DataFrame, forest: Forest) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    def confirm(batches):
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            place = {k: i for i, k in enumerate(a)}   # one row of every left side
            heads = batch.column(2).take(pa.array(list(place.values()), pa.int64())).cast(pa.binary())
            sets = dict(zip(place, shingle_sets(heads.to_pylist())))
            kept = []
            for i, other in enumerate(shingle_sets(batch.column(3).cast(pa.binary()).to_pylist())):
                mine = sets[a[i]]
                if _similar(len(np.intersect1d(mine, other, assume_unique=True)), len(mine), len(other), forest.percent):
                    kept.append(i)
            yield pa.record_batch([pa.array([a[i] for i in kept], pa.int64()), pa.array([b[i] for i in kept], pa.int64())],
                                  names=["a", "b"])

    left = members.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = members.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(confirm, "a long, b long")


def _settled(sets: list[np.ndarray], component: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """Smallest row that each row reaches over links across components (and, with two sides, across sides)."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    if n <= 6:
        common = np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in sets] for a in sets])
    else:
        _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row, keep = np.repeat(np.arange(n), sizes), count[column] > 1   # a shingle of one set is in no intersection
        row, column = row[keep], np.unique(column[keep], return_inverse=True)[1]
        common = np.zeros((n, n), dtype=np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 8192):
            at = slice(*np.searchsorted(column, [lo, lo + 8192]))
            part = np.zeros((n, min(8192, int(column[-1]) + 1 - lo)), dtype=np.float32)
            part[row[at], column[at] - lo] = 1
            common += part @ part.T
        common = np.rint(common).astype(np.int64)
    linked = _similar(common, sizes[:, None], sizes[None, :], percent) & (component[:, None] != component[None, :])
    if side.min() != side.max():
        linked &= side[:, None] != side[None, :]
    i, j = np.nonzero(np.triu(linked, 1))
    # rows of one component reach one another already
    _, same = np.unique(component, return_inverse=True)
    lead = np.full(same.max() + 1, n)
    np.minimum.at(lead, same, np.arange(n))
    return _labelled(n, np.concatenate([i, np.arange(n)]), np.concatenate([j, lead[same]]))


def _settle(forest: Forest):
    """Arrow function over tasks sorted by (cluster, x, y): connections (a, b) between components."""
    def work(batches):
        held = None
        for batch in _closed(batches):
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            key = np.stack([table.column(c).to_numpy() for c in ("cluster", "x", "y")], axis=1)
            edges = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, table.num_rows]
            held = table.slice(edges[-2])   # may go on in the next batch
            yield from done(table, edges[:-1])
        if held is not None:
            yield from done(held, np.array([0, held.num_rows]))

    def done(table, edges):
        if len(edges) < 2:
            return
        table = table.slice(0, edges[-1]).combine_chunks()
        component, side = (table.column(c).to_numpy() for c in ("component", "block"))
        out_a, out_b = [], []
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if (component[lo:hi] == component[lo]).all():
                continue
            part = table.column("text").slice(lo, hi - lo).combine_chunks().cast(pa.binary()).to_pylist()
            label = _settled(shingle_sets(part), component[lo:hi], side[lo:hi], forest.percent)
            before, after = component[lo:hi], component[lo:hi][label]
            moved = np.unique(np.stack([before, after], axis=1)[before != after], axis=0)
            out_a.append(moved[:, 0]), out_b.append(moved[:, 1])
        if out_a:
            yield pa.record_batch([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    return work


def _closed(batches):
    """Batches with rows, of at most a few hundred rows each."""
    return (b for b in batches if b.num_rows)


def near_duplicates(docs: DataFrame, forest: Forest = Forest(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row."""
    rows = stored(signed(docs, forest, doc_id, text), "signatures")
    some = rows.where("class_key is not null and doc_id is not null")
    heads = stored(some.groupBy("class_key").agg(F.min("doc_id").alias("id"), F.first("labels").alias("labels"),
                                                 F.first("sketch").alias("sketch")), "classes")
    named = stored(rows.select("doc_id", "n_shingles", "class_key").join(heads.select("class_key", "id"), "class_key", "left")
                   .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("id")).alias("id")), "named")
    pairs, clusters = _pairs(heads, forest)
    clusters = stored(clusters, "clusters")
    large = clusters.groupBy("cluster").agg(F.count("*").alias("n")).where(F.col("n") > forest.block).select("cluster")
    members = stored(docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
                     .join(clusters, "id"), "members")

    # classes that share a doc_id are one document
    shared = (named.where("id is not null").groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b"))
              .where("a <> b").select("doc_id", "a"))
    shared = named.join(shared, "doc_id").select("a", F.col("id").alias("b")).where("a <> b")

    # three near neighbours of every class of a large cluster: the nearest, and two of the very near ones
    inside = stored(clusters.join(large, "cluster").select("id"), "in-large-clusters")
    ends = pairs.join(inside.select(F.col("id").alias("a")), "a", "left_semi")
    ends = ends.select(F.col("a").alias("id"), "a", "b", "equal").union(ends.select(F.col("b").alias("id"), "a", "b", "equal"))
    near = F.col("equal") >= int(0.85 * forest.hashes)
    order = [F.struct("equal", "a", "b"), *[F.struct(near, F.xxhash64("a", "b", F.lit(k)), "a", "b") for k in (1, 2)]]
    picks = ends.groupBy("id").agg(*[F.max_by(F.struct("a", "b"), o).alias(f"p{k}") for k, o in enumerate(order)])
    picks = picks.select(F.explode(F.array("p0", "p1", "p2")).alias("p")).select("p.a", "p.b").distinct()
    links = stored(_confirmed(picks, members.join(inside, "id", "left_semi"), forest).union(shared), "links")

    groups = components(links)
    placed = clusters.join(groups, clusters.id == groups.node, "left").select(
        "id", "cluster", F.coalesce("component", "id").alias("component"))
    # blocks are dealt before the texts travel, so a large cluster is many groups from there on
    tasks = (_tasks(stored(placed, "placed"), ["cluster"], forest.block).join(members.select("id", "text"), "id")
             .repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y"))
    more = stored(tasks.select("text", "component", "cluster", "block", "x", "y").mapInArrow(_settle(forest), "a long, b long"),
                  "links")
    # ``more`` joins components of ``groups``
    final = components(more).select(F.col("node").alias("component"), F.col("component").alias("final"))
    found = named.join(groups, named.id == groups.node, "left").withColumn("component", F.coalesce("component", "id"))
    return (found.join(final, "component", "left")
            .select("doc_id", "n_shingles", F.coalesce("final", "component", "doc_id").alias("component_id")))


def deduplicated(docs: DataFrame, forest: Forest = Forest(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every group of near-duplicates (that of the smallest id), with its own columns.

    Rows that repeat an id are one document, of which one row stays; rows whose id is null all stay.
    """
    found = near_duplicates(docs, forest, doc_id, text)
    heads = found.where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count("*").alias("copies"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{doc_id}`").cast("long").alias("doc_id"))
    joined = rows.join(heads, "doc_id")
    repeated = joined.where("copies > 1").groupBy("doc_id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return (joined.where("copies = 1").select("row").union(repeated.select("row"))
            .union(rows.where("doc_id is null").select("row")).select("row.*"))
