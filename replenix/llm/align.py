"""Operator 13, cross-tokenizer alignment: lockstep vectorised merging of two tokenizations of the same bytes.

Tokenizer A (byte-level BPE) and tokenizer B (pieces with byte fallback, which puts a blank in front) cut the same
bytes into tokens.  A lane is a stretch of text that both tokenizers treat by itself: a document is cut into lanes at
single blanks between other characters, where either always begins a token.  One NumPy state vector holds the A and the
B pointer of every lane of a batch; each step links the two tokens under the pointers, moves the pointer of the token
that ends first (both, where both end: a cut), and lanes that are done leave the vector.  Lanes met before are
remembered, so a batch advances only its new ones; results of documents are put together from those of their lanes.

An id pair's count is the number of documents that hold it linked.  Tasks sum their own counts before they are
shuffled.  The most frequent pairs, ``Alignment.looked_up`` of them at most, go to the tasks that look counts up; the
links of rarer pairs meet their counts in a join.

Defined results: texts that are null, empty or whose tokens of either side do not spell " " + text (U+2581 in them, for
instance) have no tokens: zeros, no groups.  Every row is a document, also where ids repeat or are null.
"""

from __future__ import annotations

import hashlib
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replenix.llm.common import shared_folder, ship, stored, texts

BLANK = "▁"
_SAFE_BLANK = re.compile(r"(?<=\S) (?=\S)")
_PART_BYTES = 4 << 20     # text of a batch that is worked on at once
_TOGETHER = 512           # new lanes that are tokenized as one text
_LIST = 100_000           # counted pairs in one row
_NO_LANE, _OTHERWISE = -1, -2   # white space at an end: not a lane inside a text; tokens spell something else


@dataclass(frozen=True)
class Alignment:
    """Bounds of the work; none of them changes a result."""

    lanes: int = 600_000        # lanes remembered by a worker
    lane_links: int = 6_000_000  # links of them
    longest: int = 64           # characters of a lane that is remembered
    held_pairs: int = 1_000_000  # distinct pairs that a task counts before it hands them on
    looked_up: int = 2_000_000  # pairs whose counts go to every task (14 bytes each)


def lockstep(a_ends: np.ndarray, a_first: np.ndarray, b_ends: np.ndarray, b_first: np.ndarray):
    """Links (A token, B token), cuts (A token, B token that both end there) of all lanes, each in order of the text.

    ``a_ends`` are the byte offsets at which the A tokens end, lane after lane; lane k has the tokens ``a_first[k]`` to
    ``a_first[k + 1]`` (excluded), and ends at the same byte in A and B.  Lanes without tokens have no links.
    """
    a, b = a_first[:-1].copy(), b_first[:-1].copy()   # the state: one pointer pair per lane
    last = a_first[1:]
    going = np.flatnonzero(a < last)
    a, b, last = a[going], b[going], last[going]
    links, cuts = [], []
    while len(a):
        links.append((a, b))
        ends = a_ends[a] - b_ends[b]
        cut = ends == 0
        cuts.append((a[cut], b[cut]))
        a, b = a + (ends <= 0), b + (ends >= 0)
        open_ = a < last     # both run out together, at the lane's last byte
        if not open_.all():
            a, b, last = a[open_], b[open_], last[open_]

    def in_order(pairs):
        one = np.concatenate([p[0] for p in pairs]) if pairs else np.empty(0, dtype=np.int64)
        two = np.concatenate([p[1] for p in pairs]) if pairs else np.empty(0, dtype=np.int64)
        order = np.argsort(one + two, kind="stable")   # grows with every step of a lane, and from lane to lane
        return one[order], two[order]

    return (*in_order(links), *in_order(cuts))


class Tokenizers:
    """The two public tokenizers with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs one worker per core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = _byte_level()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for piece, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(map(byte_of.get, piece)) if all(c in byte_of for c in piece) else piece.encode()
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], dtype=np.int64)

    def ids(self, text: str) -> tuple[list[int], list[int]] | None:
        """(A ids of " " + text, B ids of text), None if either does not spell " " + text."""
        a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.b.encode(text)
        want = (" " + text).encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != want or b"".join(map(self.b_bytes.__getitem__, b)) != want:
            return None
        return a, b


def _byte_level() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 bytes stand for themselves, the others follow 255."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Aligns the texts of a worker, lane by lane; lanes seen of late are remembered."""

    def __init__(self, tokenizers: Tokenizers, bounds: Alignment):
        self.t, self.bounds, self.width = tokenizers, bounds, len(tokenizers.b_bytes)
        self.names = [f"{i}{sign}" for n, signs in ((len(tokenizers.a_bytes), ",|"), (self.width, ",;\n"))
                      for i in range(n) for sign in signs]
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}      # lane -> its number, or one of the two below
        self.groups: list[str] = []           # per lane
        self.counts = np.zeros((1 << 12, 4), dtype=np.int64)   # tokens of A, of B, groups, links per lane
        self.place = np.zeros(1 << 12, dtype=np.int64)         # lane n has links[place[n]:place[n + 1]]
        self.links = np.empty(1 << 14, dtype=np.int64)

    def align(self, batch: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """(counts per text, groups per text, links of all texts, offsets of the texts in them).

        The four counts are tokens of A, tokens of B, groups and links.  A link is A id * number of B pieces + B id.
        """
        if len(self.groups) > self.bounds.lanes or self.place[len(self.groups)] > self.bounds.lane_links:
            self._forget()
        number = self.number
        lanes = [t.split(" ") if t else [] for t in batch]
        self._learn({u for us in lanes for u in us if u not in number})
        codes = [list(map(number.__getitem__, us)) for us in lanes]
        for k, cs in enumerate(codes):
            if _NO_LANE in cs:
                us = _SAFE_BLANK.split(batch[k])
                once = self._learn_each([u for u in us if number.get(u, _NO_LANE) == _NO_LANE])
                codes[k] = cs = [next(once) if number.get(u, _NO_LANE) == _NO_LANE else number[u] for u in us]
            if _OTHERWISE in cs:
                codes[k] = []
        for u in [u for u in number if len(u) > self.bounds.longest] if self.any_long else ():
            del number[u]
        return self._joined(codes)

    def _joined(self, codes: list[list[int]]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Results of texts from those of their lanes."""
        flat = np.array([c for cs in codes for c in cs], dtype=np.int64)
        edges = np.cumsum([0, *map(len, codes)])
        before = np.zeros((len(flat) + 1, 4), dtype=np.int64)
        np.cumsum(self.counts[flat], axis=0, out=before[1:])
        first = self.place[flat]
        sizes = self.place[flat + 1] - first
        offsets = np.cumsum(np.r_[0, sizes])
        links = self.links[np.repeat(first - offsets[:-1], sizes) + np.arange(offsets[-1])]
        strings = [";".join(map(self.groups.__getitem__, cs)) for cs in codes]
        return before[edges[1:]] - before[edges[:-1]], strings, links, offsets[edges]

    def _learn(self, new: set[str]) -> None:
        """Lanes between single blanks: many are tokenized as one text and told apart by the bytes of their tokens."""
        lanes, self.any_long = [], False
        for u in new:
            self.any_long |= len(u) > self.bounds.longest
            if not u or u[0].isspace() or u[-1].isspace():
                self.number[u] = _NO_LANE
            elif BLANK in u:
                self.number[u] = _OTHERWISE
            else:
                lanes.append(u)
        for lo in range(0, len(lanes), _TOGETHER):
            part = lanes[lo:lo + _TOGETHER]
            ids = self.t.ids(" ".join(part))
            if ids is None:    # one of them is spelled otherwise
                self.number.update(zip(part, self._learn_each(part)))
            else:
                first = self._keep(*ids, np.cumsum([len(u.encode()) + 1 for u in part]))
                self.number.update(zip(part, range(first, first + len(part))))

    def _learn_each(self, lanes: list[str]):
        """Numbers of lanes tokenized one by one."""
        for u in lanes:
            ids = self.t.ids(u)
            yield _OTHERWISE if ids is None else self._keep(*ids, np.array([len(u.encode()) + 1]))

    def _keep(self, a_ids: list[int], b_ids: list[int], ends: np.ndarray) -> int:
        """Number of the first of some new lanes, the k-th of which ends at byte ``ends[k]`` of these tokens."""
        a, b = np.array(a_ids, dtype=np.int64), np.array(b_ids, dtype=np.int64)
        a_ends, b_ends = np.cumsum(self.t.a_sizes[a]), np.cumsum(self.t.b_sizes[b])
        a_first = np.r_[0, np.searchsorted(a_ends, ends) + 1]
        b_first = np.r_[0, np.searchsorted(b_ends, ends) + 1]
        if (a_ends[a_first[1:] - 1] != ends).any() or (b_ends[b_first[1:] - 1] != ends).any():
            raise ValueError("a token goes on beyond a single blank: these tokenizers cannot be aligned lane by lane")
        link_a, link_b, cut_a, cut_b = lockstep(a_ends, a_first, b_ends, b_first)
        links_of, cuts_of = np.searchsorted(link_a, a_first), np.searchsorted(cut_a, a_first)
        n, k = len(self.groups), len(ends)
        while len(self.place) <= n + k + 1:
            self.place, self.counts = np.concatenate([self.place] * 2), np.concatenate([self.counts] * 2)
        begin = int(self.place[n])
        while len(self.links) < begin + len(link_a):
            self.links = np.concatenate([self.links, np.empty_like(self.links)])
        self.links[begin:begin + len(link_a)] = a[link_a] * self.width + b[link_b]
        self.place[n + 1:n + k + 1] = begin + links_of[1:]
        self.counts[n:n + k] = np.stack([np.diff(x) for x in (a_first, b_first, cuts_of, links_of)], axis=1)
        self.groups += self._group_strings(a, b, cut_a, cut_b, cuts_of)
        return n

    def _group_strings(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, cuts_of: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2`` per lane: every token's number with the sign behind it, tokens in order of their groups."""
        group_a, group_b = np.searchsorted(cut_a, np.arange(len(a))), np.searchsorted(cut_b, np.arange(len(b)))
        sign_a, sign_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        sign_a[cut_a], sign_b[cut_b], sign_b[cut_b[cuts_of[1:] - 1]] = 1, 1, 2
        out = np.empty(len(a) + len(b), dtype=np.int64)
        out[np.arange(len(a)) + np.r_[0, cut_b + 1][group_a]] = 2 * a + sign_a       # B tokens of the groups before
        out[np.arange(len(b)) + (cut_a + 1)[group_b]] = 2 * len(self.t.a_bytes) + 3 * b + sign_b
        return "".join(map(self.names.__getitem__, out.tolist())).split("\n")[:-1]


_aligners: dict[tuple, Aligner] = {}   # of this worker


def _aligner(path_a: str, path_b: str, bounds: Alignment) -> Aligner:
    key = (path_a, path_b, bounds)
    if key not in _aligners:
        _aligners[key] = Aligner(Tokenizers(path_a, path_b), bounds)
    return _aligners[key]


def _stretches(batches):
    """(first column, texts of the second) of the batches, ``_PART_BYTES`` of text at a time, one text at least."""
    for batch in batches:
        found, lo, size = [t.decode() for t in texts(batch)], 0, 0
        for k, t in enumerate(found):
            if k > lo and size + len(t) > _PART_BYTES:
                yield batch.column(0).slice(lo, k - lo), found[lo:k]
                lo, size = k, 0
            size += len(t)
        if found[lo:]:
            yield batch.column(0).slice(lo), found[lo:]


def _runs(links: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct links of every text, ascending, how often each occurs in it, and offsets of the texts in them."""
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = (text_of << 40) | links
    order.sort()
    heads = np.flatnonzero(np.r_[True, order[1:] != order[:-1]][:len(order)])
    times = np.diff(np.r_[heads, len(order)])
    kept = order[heads]
    return kept & ((1 << 40) - 1), times, np.searchsorted(kept >> 40, np.arange(len(offsets)))


class _Counts:
    """Documents per pair, summed within a task."""

    def __init__(self, most: int):
        self.most, self.pairs, self.n = most, np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, pairs: np.ndarray) -> None:
        self.waiting.append(pairs)
        self.held += len(pairs)
        if self.held > 2 * self.most:
            self._fold()

    def _fold(self) -> None:
        new, n = np.unique(np.concatenate(self.waiting), return_counts=True) if self.waiting else (self.pairs[:0], self.n[:0])
        both = np.concatenate([self.pairs, new])
        order = np.argsort(both, kind="stable")
        heads = np.flatnonzero(np.r_[True, np.diff(both[order]) != 0][:len(both)])
        sums = np.concatenate([self.n, n])[order]
        self.pairs, self.n = both[order][heads], np.add.reduceat(sums, heads) if len(heads) else sums
        self.waiting, self.held = [], 0

    def full(self) -> bool:
        return len(self.pairs) > self.most

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self._fold()
        out, self.pairs, self.n = (self.pairs, self.n), self.pairs[:0], self.n[:0]
        return out


def _lists(offsets: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
    return [pa.ListArray.from_arrays(pa.array(offsets.astype("i4")), pa.array(v)) for v in values]


def aligned(docs: DataFrame, path_a: str, path_b: str, bounds: Alignment = Alignment(), doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """doc_id, a_ids and b_ids of every text, its cuts and its links.

    ``cuts`` are (a, b): how many tokens of either side end at or before a common byte offset.  ``links`` are the
    positions (a, b) of tokens whose byte ranges overlap.
    """
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType),
                           *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in (
                               "a_ids", "b_ids", "cuts_a", "cuts_b", "links_a", "links_b")]])

    def work(batches):
        t = _aligner(path_a, path_b, bounds).t
        for ids, found in _stretches(batches):
            both = [x and t.ids(x) or ([], []) for x in found]
            (a, a_first), (b, b_first) = ((np.array([i for x in both for i in x[k]], dtype=np.int64),
                                           np.cumsum([0, *(len(x[k]) for x in both)])) for k in (0, 1))
            link_a, link_b, cut_a, cut_b = lockstep(np.cumsum(t.a_sizes[a]), a_first, np.cumsum(t.b_sizes[b]), b_first)
            out = [*_lists(a_first, a.astype("i4")), *_lists(b_first, b.astype("i4"))]
            for one, two, more in ((cut_a, cut_b, 1), (link_a, link_b, 0)):
                at = np.searchsorted(one, a_first)
                lane = np.repeat(np.arange(len(found)), np.diff(at))
                out += _lists(at, (one - a_first[lane] + more).astype("i4"), (two - b_first[lane] + more).astype("i4"))
            yield pa.record_batch([ids, *out], names=schema.names)

    def zipped(name: str):
        return F.arrays_zip(F.col(f"{name}_a").alias("a"), F.col(f"{name}_b").alias("b")).alias(name)

    found = _input(docs, doc_id, text).mapInArrow(work, schema)
    return found.select("doc_id", "a_ids", "b_ids", zipped("cuts"), zipped("links"))


def _input(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))


def _linked(docs: DataFrame, path_a: str, path_b: str, bounds: Alignment, doc_id: str, text: str) -> DataFrame:
    """A written table: a row per document (key, its figures, distinct pairs and how often each is linked), and rows
    without key, the documents per pair that a task has counted."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc_id", docs.schema[doc_id].dataType),
                           *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                           T.StructField("groups_sha256", T.StringType()),
                           T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))])

    def work(batches):
        aligner, counts = _aligner(path_a, path_b, bounds), _Counts(bounds.held_pairs)
        key, id_type = TaskContext.get().partitionId() << 40, None

        def counted():
            pairs, n = counts.take()
            at = np.minimum(np.arange(0, len(pairs) + _LIST, _LIST), len(pairs))
            none = pa.nulls(len(at) - 1)
            yield pa.record_batch([none.cast(pa.int64()), none.cast(id_type), *[none.cast(pa.int64())] * 4,
                                   none.cast(pa.string()), *_lists(at, pairs, n.astype("i4"))], names=schema.names)

        for ids, found in _stretches(batches):
            id_type = ids.type
            figures, strings, links, offsets = aligner.align(found)
            pairs, times, at = _runs(links, offsets)
            shas = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in strings]
            yield pa.record_batch([pa.array(key + np.arange(len(found))), ids, *(pa.array(figures[:, k]) for k in range(4)),
                                   pa.array(shas), *_lists(at, pairs, times.astype("i4"))], names=schema.names)
            key += len(found)
            counts.add(pairs)
            if counts.full():
                yield from counted()
        if id_type is not None:
            yield from counted()

    folder = shared_folder(docs.sparkSession, "linked")
    # sorted pairs: small differences, packed
    (_input(docs, doc_id, text).mapInArrow(work, schema).write.option("compression", "zstd")
     .option("parquet.enable.dictionary", "false").option("parquet.writer.version", "PARQUET_2_0").parquet(folder))
    return docs.sparkSession.read.schema(schema).parquet(folder)


def _frequent(counts: DataFrame, most: int) -> int:
    """Smallest count from which at most ``most`` pairs remain, to within a sixteenth of it."""
    step = F.floor(F.log2("n") * 12).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("n")).collect()   # < 800
    found, total = 1 << 62, 0
    for r in sorted(steps, key=lambda r: -r.step):
        total += r.pairs
        if total > most:
            break
        found = r.n
    return found


def alignments(docs: DataFrame, path_a: str, path_b: str, bounds: Alignment = Alignment(), doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    spark = docs.sparkSession
    ship(spark)
    linked = _linked(docs, path_a, path_b, bounds, doc_id, text)
    width = Tokenizers(path_a, path_b).b.get_piece_size()
    counted = linked.where("key is null").select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    counts = stored(counted.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n")), "pair-counts")
    top = counts.groupBy(F.expr(f"pair div {width}L").alias("a")).agg(F.max("n").alias("top"))
    # one row per A id: no more than its vocabulary has
    counts = stored(counts.withColumn("a", F.expr(f"pair div {width}L")).join(F.broadcast(top), "a")
                    .select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "pairs")
    least = _frequent(counts, bounds.looked_up)
    known = counts.where(F.col("n") >= least).toArrow().sort_by("pair")
    table = spark.sparkContext.broadcast(tuple(known.column(c).to_numpy() for c in ("pair", "n", "best")))

    schema = T.StructType([*(f for f in linked.schema.fields if f.name not in ("pairs", "times")),
                           T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
                           T.StructField("rare", T.ArrayType(T.LongType())), T.StructField("rare_times", T.ArrayType(T.IntegerType()))])

    def look_up(batches):
        pair, n, best = table.value
        for batch in batches:
            lists, times = batch.column(7), batch.column(8).values.to_numpy().astype(np.int64)
            pairs, edges = lists.values.to_numpy(), lists.offsets.to_numpy()
            pairs, times, edges = pairs[edges[0]:edges[-1]], times[edges[0]:edges[-1]], edges - edges[0]
            at = np.minimum(np.searchsorted(pair, pairs), max(len(pair) - 1, 0))
            met = pair[at] == pairs if len(pair) else np.zeros(len(pairs), dtype=bool)
            at[~met] = 0
            sums = [np.diff(np.r_[0, np.cumsum(np.where(met, values[at] * times, 0) if len(pair) else times * 0)][edges])
                    for values in (best, n)]
            rare = np.r_[0, np.cumsum(~met)][edges]
            yield pa.record_batch([*(batch.column(k) for k in range(7)), *map(pa.array, sums),
                                   *_lists(rare, pairs[~met], times[~met].astype("i4"))], names=schema.names)

    found = stored(linked.where("key is not null").mapInArrow(look_up, schema), "looked-up")
    rare = found.where(F.size("rare") > 0).select("key", F.explode(F.arrays_zip("rare", "rare_times")).alias("x"))
    rare = (rare.select("key", F.col("x.rare").alias("pair"), F.col("x.rare_times").alias("times"))
            .join(counts.where(F.col("n") < least), "pair").groupBy("key")
            .agg(F.sum(F.col("n") * F.col("times")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")))
    none = F.lit(0).cast("long")
    return found.drop("rare", "rare_times").join(rare, "key", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", none)).alias("count_sum"), "groups_sha256")
