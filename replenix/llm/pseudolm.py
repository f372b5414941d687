"""Operator 4, LM scoring: masked pseudo-likelihood by a bidirectional window network.

Tokens are the words of a text.  The most frequent ones of the corpus (counted over all documents) have a class of
their own, as soon as they are counted ``Training.least`` times; all others share 64 classes by their ending.  A
network of one hidden layer sees two tokens on either side and predicts the class of the masked one between them, in
two levels: its group of 32 classes, then the class within the group, which gives exact log-probabilities of 1,024
classes from 64 outputs.  The word within its class is predicted from the counts of all words of the corpus, a written
table.  log P(token) = log P(class | sides) + log P(word | class).

The network is trained in numpy on the windows of all tokens of all documents, each in one of the rounds.  Documents
are dealt by a hash into shards of about ``Training.shard`` tokens; every shard is trained on from the same start, and
the weights are averaged between rounds in order of the shards, so the model does not depend on cores or files.  A
document's score is the sum of the conditional log-probabilities of all its tokens.

Defined results: null and empty texts have no tokens, score 0.0 and no mean; a one-word text is predicted from
padding alone; a corpus without words leaves the network as it began; repeated rows are scored alike.  With N
occurrences of V words in a class, a word counted n times has n / (N + V), and the words never counted share
V / (N + V) by their bytes (each of 257, an end included).
"""

from __future__ import annotations

import hashlib
import math
import zlib
from dataclasses import dataclass
from itertools import chain, product, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenix.llm.common import ship, stored

SIDE = 2
ENDINGS = 64
MEMBERS = 32
GROUPS = 32
CLASSES = GROUPS * MEMBERS
WORDS = CLASSES - ENDINGS - 1     # class 0 is the padding beyond a text's ends
COUNTED = 1 << 25     # bytes of words that a task counts at once
SAFE = 60.0           # logits below need no largest one taken off: their exponentials and sums are single-precision numbers


@dataclass(frozen=True)
class Training:
    hidden: int = 24
    rounds: int = 3
    batch: int = 4096
    rate: float = 0.06
    seed: int = 3
    least: int = 2          # occurrences from which a word may have a class of its own
    shard: int = 1 << 21    # tokens that one trainer sees, about
    listed: int = 1 << 21   # workers hold the words that are one in so many tokens; rarer ones are joined


class Vocabulary:
    """Own classes of the most frequent words, ``counts`` of all words, and those that workers look up."""

    def __init__(self, words: list[str], counts: DataFrame | None = None, totals: list[tuple[int, int]] | None = None,
                 listed: list[tuple[str, int]] = (), tokens: int = 0):
        self.words = words
        self.classes = {w.encode(): 1 + ENDINGS + i for i, w in enumerate(words[:WORDS])}
        self.counts = counts   # w, n and ending of all words of the corpus
        self.totals = totals or [(0, 0)] * ENDINGS   # (occurrences, words) of every ending
        self.tokens = tokens
        self.all = [math.log(max(n + v, 1)) for n, v in self.totals]
        self.unseen = [math.log(v / (n + v)) if v else 0.0 for n, v in self.totals]
        self.places = None
        self.listed = {w.encode(): self.within(w.encode(), n) for w, n in listed} | dict.fromkeys(self.classes, 0.0)

    def __getstate__(self):
        return self.__dict__ | {"places": None, "counts": None}

    def _class(self, word: bytes) -> int:
        return self.classes.get(word) or 1 + zlib.crc32(word[-2:]) % ENDINGS

    def within(self, word: bytes, n: int) -> float:
        """log P(word | class) of a word that the corpus has ``n`` times."""
        if word in self.classes:
            return 0.0
        e = zlib.crc32(word[-2:]) % ENDINGS
        return math.log(n) - self.all[e] if n else self.unseen[e] - (len(word) + 1) * math.log(257)

    def looked_up(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """Where the words of every text begin, classes of all words, one after the other, log P(word | class) of the
        listed ones (0 for the others), and the places of the others with these words.  Different words are looked up once."""
        if self.places is None:
            self.places = dict(zip(self.listed, range(len(self.listed))))
            self.values = np.array([*self.listed.values(), 0.0])
            self.own = np.array([*map(self._class, self.listed), 0], dtype=np.uint16)
        edges, words = split_words(texts)
        words = words.dictionary_encode()
        which, different = words.indices.to_numpy(zero_copy_only=False), words.dictionary
        as_bytes = different.cast(pa.large_binary() if pa.types.is_large_string(different.type) else pa.binary())
        at = np.fromiter(map(self.places.get, as_bytes.to_numpy(zero_copy_only=False), repeat(-1)), dtype=np.int64, count=len(different))
        classes_ = np.where(at < 0, by_ending(as_bytes), self.own[at])   # all words with a class of their own are listed
        others = np.flatnonzero((at < 0)[which])
        return edges, classes_[which], self.values[at][which], others, different.take(pa.array(which[others]))

    def joined(self, rare: DataFrame) -> DataFrame:
        """``rare`` (w, ...) with ``within``, from the table of counts."""
        all_, unseen = (F.element_at(F.array(*map(F.lit, t)), F.col("ending") + 1) for t in (self.all, self.unseen))
        seen, unseen = F.ln("n") - all_, unseen - (F.octet_length("w") + 1) * F.lit(math.log(257))
        found = rare.join(self.counts.select("w", "n"), "w", "left").withColumn("ending", ending("w"))
        return found.withColumn("within", F.coalesce(seen, unseen)).drop("n", "ending")

    def padded(self, text: bytes) -> np.ndarray:
        """Classes of all words with ``SIDE`` classes of padding around them."""
        return np.pad(self.looked_up(pa.array([text.decode()]))[1], SIDE)


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where the words of every text (null: none) begin, and all words, one after the other."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    edges, words = lists.offsets.to_numpy().astype(np.int64), lists.values
    there = pc.not_equal(words, "")     # white space at an end of a text leaves an empty piece
    edges = np.r_[0, np.cumsum(there.to_numpy(zero_copy_only=False))][edges]
    return edges, words.filter(there)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """w and n of all words of all documents: counted by every task some megabytes at a time, then added up."""
    def counted(batches):
        held, size = [], 0
        for batch in batches:
            words = split_words(batch.column(0))[1]
            held, size = [*held, words], size + words.nbytes
            if size >= COUNTED:
                yield part(held)
                held, size = [], 0
        if held:
            yield part(held)

    def part(held):
        found = pa.chunked_array(held).value_counts()
        return pa.record_batch([found.field("values"), found.field("counts")], names=["w", "n"])

    ship(docs.sparkSession)
    parts = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(counted, "w string, n long")
    return parts.groupBy("w").agg(F.sum("n").alias("n"))


_ENDS = np.array([1 + zlib.crc32(bytes(e)) % ENDINGS for e in chain(product(range(256), repeat=2), product(range(256)))],
                 dtype=np.uint16)   # classes of all endings of two bytes, then of one


def by_ending(words: pa.Array) -> np.ndarray:
    """Class by ending of every word, none of them empty."""
    _, offsets, data = words.buffers()
    wide = "i8" if pa.types.is_large_binary(words.type) else "i4"
    edges = np.frombuffer(offsets, dtype=wide)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(data or b"", dtype=np.uint8)
    last = data[edges[1:] - 1].astype(np.int64)
    return _ENDS[np.where(np.diff(edges) < 2, (1 << 16) + last, data[edges[1:] - 2].astype(np.int64) * 256 + last)]


def ending(word: str) -> Column:
    """Number of the class by ending (from 0) of a word column."""
    data = F.col(word).cast("binary")
    last = F.when(F.octet_length(data) < 2, data).otherwise(F.substring(data, -2, 2))
    return (F.crc32(last) % ENDINGS).cast("int")


def vocabulary(docs: DataFrame, text: str = "text", training: Training = Training()) -> Vocabulary:
    """Counts of all words of all documents; the most frequent ones (ties by code point) have their own class."""
    counts = stored(word_counts(docs, text).withColumn("ending", ending("w")), "word-counts")
    top = counts.where(F.col("n") >= training.least).orderBy(F.desc("n"), "w").limit(WORDS)   # a bounded list
    top = [r["w"] for r in top.collect()]
    sums = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    tokens = sum(r["n"] for r in sums)
    # one word in ``listed`` tokens at least: not more words than that
    listed = [(r["w"], r["n"]) for r in counts.where(F.col("n") * training.listed >= tokens).collect()]
    totals = {r["ending"]: [r["n"], r["words"]] for r in sums}
    own = counts.where(F.col("w").isin(top)).collect() if top else []
    for r in own:
        totals[r["ending"]][0] -= r["n"]
        totals[r["ending"]][1] -= 1
    return Vocabulary(top, counts, [tuple(totals.get(e, (0, 0))) for e in range(ENDINGS)], sorted(listed), tokens)


def row_maxima(values: np.ndarray) -> np.ndarray:
    """The largest value of every row, as a column: halves are compared whole, as rows are too short to go through singly."""
    while values.shape[1] > 1:
        half = values.shape[1] // 2
        largest = np.maximum(values[:, :half], values[:, half:2 * half])
        if values.shape[1] % 2:
            np.maximum(largest[:, :1], values[:, -1:], out=largest[:, :1])
        values = largest
    return values


class WindowNet:
    """Tables per side position (classes -> hidden), one tanh layer, softmax over groups and over the classes in each."""

    def __init__(self, training: Training):
        rng = np.random.default_rng(training.seed)
        h = training.hidden
        self.tables = rng.normal(0, 0.3, (2 * SIDE, CLASSES, h)).astype("f4")
        self.hidden_bias = np.zeros(h, dtype="f4")
        self.group = rng.normal(0, 0.1, (h, GROUPS)).astype("f4")
        self.group_bias = np.zeros(GROUPS, dtype="f4")
        self.member = rng.normal(0, 0.1, (GROUPS, h, MEMBERS)).astype("f4")
        self.member_bias = np.zeros((GROUPS, MEMBERS), dtype="f4")

    def parameters(self) -> list[np.ndarray]:
        return [self.tables, self.hidden_bias, self.group, self.group_bias, self.member, self.member_bias]

    def to_bytes(self) -> bytes:
        return b"".join(p.astype("<f4").tobytes() for p in self.parameters())

    def load(self, data: np.ndarray) -> "WindowNet":
        at = 0
        for p in self.parameters():
            p[...] = data[at:at + p.size].reshape(p.shape)
            at += p.size
        return self

    def _hidden(self, context: np.ndarray) -> np.ndarray:
        total = self.hidden_bias + np.take(self.tables[0], context[:, 0], axis=0)
        for k in range(1, 2 * SIDE):
            total += np.take(self.tables[k], context[:, k], axis=0)
        return np.tanh(total, out=total)

    def _levels(self) -> tuple[np.ndarray, np.ndarray, bool]:
        """Weights of both levels with their biases as last row, and whether any logit may be beyond ``SAFE``."""
        outer, inner = np.vstack([self.group, self.group_bias]), np.concatenate([self.member, self.member_bias[:, None]], axis=1)
        largest = max(np.abs(outer).sum(axis=0).max(), np.abs(inner).sum(axis=1).max())   # the hidden layer is within 1
        return outer, inner, not largest < SAFE

    def _softmax(self, context: np.ndarray, target: np.ndarray):
        """Tokens in order of their groups (``order``), their hidden layer with a last column of ones, and of both levels
        the exponentials of the logits, their sums, the places of the targets and their logits; ``runs`` are the
        stretches of equal groups."""
        outer, inner, large = self._levels()
        order = np.argsort(target // MEMBERS, kind="stable")
        own = np.take(target, order).astype(np.int64)
        hidden = np.ones((len(own), outer.shape[0]), dtype=outer.dtype)
        hidden[:, :-1] = self._hidden(np.take(context, order, axis=0))
        groups, members = own // MEMBERS, own % MEMBERS
        edges = np.searchsorted(groups, np.arange(GROUPS + 1))
        runs = [(g, slice(x, y)) for g, (x, y) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())) if x < y]
        within = np.empty((len(own), MEMBERS), dtype=hidden.dtype)
        for g, run in runs:
            np.matmul(hidden[run], inner[g], out=within[run])
        levels = []
        for logits, chosen in ((hidden @ outer, groups), (within, members)):
            if large:
                logits -= row_maxima(logits)
            places = chosen + np.arange(0, logits.size, logits.shape[1])
            mine = np.take(logits, places).astype(np.float64)
            np.exp(logits, out=logits)
            levels.append((logits, logits @ np.ones(logits.shape[1], dtype=logits.dtype), places, mine))
        return order, hidden, levels, runs

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        out = np.empty(len(target), dtype=np.float64)
        for k in range(0, len(target), 8192):
            order, _, levels, _ = self._softmax(context[k:k + 8192], target[k:k + 8192])
            out[k + order] = sum(mine - np.log(total) for _, total, _, mine in levels)
        return out

    def gradients(self, context: np.ndarray, target: np.ndarray) -> tuple[float, list]:
        """Mean loss, and its gradients as (parameter, rows that it changes or ..., gradient)."""
        n = len(target)
        order, hidden, levels, runs = self._softmax(context, target)
        loss = -float(sum(mine - np.log(total) for _, total, _, mine in levels).mean())
        for p, total, places, _ in levels:
            p *= (1 / (total * n))[:, None]
            p.reshape(-1)[places] -= p.dtype.type(1 / n)
        outer, inner = levels[0][0], levels[1][0]
        ones = np.ones(n, dtype=hidden.dtype)
        by_group = hidden.T @ outer      # the last row is the bias's
        by_member = np.zeros((GROUPS, *by_group.shape[:1], MEMBERS), dtype=hidden.dtype)
        below = np.empty((n, self.group.shape[0]), dtype=hidden.dtype)
        for g, run in runs:
            np.matmul(hidden[run].T, inner[run], out=by_member[g])
            np.matmul(inner[run], self.member[g].T, out=below[run])
        below += outer @ self.group.T
        hidden = np.ascontiguousarray(hidden[:, :-1])
        hidden *= hidden
        below *= np.subtract(1, hidden, out=hidden)
        changes = [(self.group, ..., by_group[:-1]), (self.group_bias, ..., by_group[-1]),
                   (self.member, ..., by_member[:, :-1]), (self.member_bias, ..., by_member[:, -1]),
                   (self.hidden_bias, ..., ones @ below)]
        # rows of the tables, by side and class; sums over runs of equal ones
        rows = (np.take(context, order, axis=0).T + np.arange(0, 2 * SIDE * CLASSES, CLASSES, dtype=np.uint16)[:, None]).ravel()
        by_row = np.argsort(rows, kind="stable")
        own = rows[by_row]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        sums = np.add.reduceat(np.take(below, np.tile(np.arange(n), 2 * SIDE)[by_row], axis=0), starts, axis=0)
        changes.append((self.tables, np.divmod(own[starts].astype(np.int64), CLASSES), sums))
        return loss, changes

    def train(self, windows: np.ndarray, training: Training, sums: list[np.ndarray]) -> None:
        """One pass (Adagrad; ``sums`` carries the squared gradients) over windows of 2 * SIDE + 1 classes."""
        others = [k for k in range(2 * SIDE + 1) if k != SIDE]
        of = {id(p): s for p, s in zip(self.parameters(), sums)}
        for i in range(0, len(windows), training.batch):
            part = windows[i:i + training.batch]
            for p, rows, g in self.gradients(part[:, others], part[:, SIDE])[1]:
                s = of[id(p)]
                squares = s[rows] + g * g
                s[rows] = squares
                p[rows] -= (training.rate * g / (np.sqrt(squares) + 1e-6)).astype(p.dtype)


def contexts(padded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(classes on both sides, own class) of every token."""
    n = len(padded) - 2 * SIDE
    sides = [padded[k:k + n] for k in range(2 * SIDE + 1) if k != SIDE]
    return np.stack(sides, axis=1), padded[SIDE:SIDE + n]


_ENCODED = "k string, row long, n_tokens long, padded binary, within double, rare array<string>"


def encoded(docs: DataFrame, words: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A written table of every row's text in classes: ``padded`` (two bytes each, with padding around them), the sum of
    log P(word | class) of its listed words, and its other words (``rare``).  ``row`` tells rows of one key apart."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def look_up(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            edges, classes_, within, others, words_ = shared.value.looked_up(batch.column(1))
            rows = len(edges) - 1
            sums = np.r_[0, np.cumsum(within)][edges]
            ends = 2 * (edges + 2 * SIDE * np.arange(len(edges)))     # two bytes a class, padding around every text
            padded = np.zeros(ends[-1] // 2, dtype=np.uint16)
            padded[np.arange(len(classes_)) + np.repeat(2 * SIDE * np.arange(rows) + SIDE, np.diff(edges))] = classes_
            padded = pa.BinaryArray.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends.astype("i4")), pa.py_buffer(padded)])
            rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(others, edges).astype("i4")), words_)
            yield pa.record_batch([batch.column(0), pa.array(row + np.arange(rows)), pa.array(np.diff(edges)),
                                   padded, pa.array(np.diff(sums)), rare],
                                  names=["k", "row", "n_tokens", "padded", "within", "rare"])
            row += rows

    return stored(docs.select(F.col(f"`{key}`").cast("string").alias("k"), F.col(f"`{text}`").alias("text"))
                  .mapInArrow(look_up, _ENCODED), "classes")


def windows(padded: np.ndarray, r: int, training: Training):
    """The windows of round ``r``: every token of the padded texts is the middle of one window of one round."""
    middle = np.flatnonzero(padded)[r::training.rounds]   # class 0 is the padding between the texts
    size = 64 * training.batch
    for i in range(0, len(middle), size):
        yield padded[middle[i:i + size, None] + np.arange(-SIDE, SIDE + 1)]


def fit(docs: DataFrame, training: Training = Training(), key: str = "doc_id", text: str = "text"
        ) -> tuple[Vocabulary, WindowNet]:
    words = vocabulary(docs, text, training)
    return words, trained_net(encoded(docs, words, key, text), words, training)


def trained_net(table: DataFrame, words: Vocabulary, training: Training) -> WindowNet:
    """The network of an encoded corpus."""
    spark = table.sparkSession
    gathered = shards(table.where("n_tokens > 0").select("k", "padded"), words.tokens, training)
    net = WindowNet(training)
    for r in range(training.rounds):
        start = spark.sparkContext.broadcast(net.to_bytes())

        def trained(batches, r=r, start=start):
            for batch in batches:
                for shard, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    own = WindowNet(training).load(np.frombuffer(start.value, dtype="<f4"))
                    sums, seen = [np.zeros_like(p) for p in own.parameters()], 0
                    for part in windows(np.frombuffer(data, dtype=np.uint16), r, training):   # every round trains on others
                        own.train(part, training, sums)
                        seen += len(part)
                    if seen:
                        yield pa.record_batch([pa.array([shard], pa.int64()), pa.array([seen], pa.int64()),
                                               pa.array([own.to_bytes()], pa.binary())], names=["shard", "n", "net"])

        parts = gathered.mapInArrow(trained, _NETS)
        for _ in range(_levels(words.tokens // training.shard + 1)):
            parts = (parts.withColumn("of", F.floor(F.col("shard") / _TOGETHER)).groupBy("of")
                     .applyInArrow(_averaged, _NETS))
        parts = [(p["shard"], p["n"], np.frombuffer(p["net"], dtype="<f4").astype("f8")) for p in parts.collect()]
        total = sum(n for _, n, _ in parts)
        if total:
            net.load(sum(w * (n / total) for _, n, w in sorted(parts, key=lambda p: p[0])).astype("f4"))
    return net


_NETS = "shard long, n long, net binary"
_TOGETHER = 32   # networks that are averaged by one task, or on the driver


def _levels(shards_: int) -> int:
    """Rounds of averaging until the driver gets few networks, however many trainers there are."""
    levels = 0
    while shards_ > _TOGETHER:
        shards_, levels = -(-shards_ // _TOGETHER), levels + 1
    return levels


def _averaged(table: pa.Table) -> pa.Table:
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("shard", "n", "net"))))
    total = sum(n for _, n, _ in rows)
    mean = sum(np.frombuffer(data, dtype="<f4").astype("f8") * (n / total) for _, n, data in rows)
    return pa.table({"shard": [rows[0][0] // _TOGETHER], "n": [total], "net": pa.array([mean.astype("<f4").tobytes()], pa.binary())})


def shards(classes_: DataFrame, tokens: int, training: Training) -> DataFrame:
    """A written table (shard, data): the padded texts of every shard, one after the other in a fixed order.

    The shard follows from a hash of key and text, their number from the tokens of the corpus, so a shard holds an even
    share of them, whatever keys repeat or are null."""
    number = tokens // training.shard + 1

    def gather(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("k").to_pylist(), table.column("padded").to_pylist()), key=lambda r: (r[0] or "", r[1]))
        return pa.table({"shard": table.column("shard")[:1].cast(pa.int64()),
                         "data": pa.array([b"".join(p for _, p in rows)], pa.large_binary()).cast(pa.binary())})

    dealt = classes_.withColumn("shard", F.pmod(F.xxhash64("k", "padded"), F.lit(number)))
    return stored(dealt.groupBy("shard").applyInArrow(gather, "shard long, data binary").repartition("shard"), "classes")


_models: dict[str, WindowNet] = {}   # of this worker


def scores(docs: DataFrame, words: Vocabulary, net: WindowNet, training: Training, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``key``, n_tokens and log_likelihood of every row: the sum of log P(token) of all its tokens."""
    return scored(encoded(docs, words, key, text), words, net, training).select(
        F.col("k").cast(docs.schema[key].dataType).alias(key), "n_tokens", "log_likelihood")


def scored(table: DataFrame, words: Vocabulary, net: WindowNet, training: Training) -> DataFrame:
    """k, n_tokens and log_likelihood of every row of an encoded table."""
    data = net.to_bytes()
    name, shared = hashlib.sha256(data).hexdigest(), table.sparkSession.sparkContext.broadcast(data)

    def score(batches):
        if name not in _models:
            _models.clear()
            _models[name] = WindowNet(training).load(np.frombuffer(shared.value, dtype="<f4"))
        for batch in batches:
            n, within = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            sums = np.zeros(len(n))
            if n.any():
                padded = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint16)
                middle = np.flatnonzero(padded)     # class 0 is the padding between the texts
                each = _models[name].log_probabilities(
                    np.stack([padded[middle + k] for k in range(-SIDE, SIDE + 1) if k], axis=1), padded[middle])
                sums = np.diff(np.r_[0, np.cumsum(each)][np.cumsum(np.r_[0, n])])
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(sums + within)],
                                  names=["k", "row", "n_tokens", "score"])

    found = stored(table.mapInArrow(score, "k string, row long, n_tokens long, score double"), "scored")
    # added up as whole billionths: the sum does not depend on the order of the rows
    billionths = F.sum(F.round(F.col("within") * 1e9).cast("long")).alias("more")
    more = words.joined(table.select("row", F.explode("rare").alias("w"))).groupBy("row").agg(billionths)
    return found.join(more, "row", "left").select(
        "k", "n_tokens", (F.col("score") + F.coalesce("more", F.lit(0)) / 1e9).alias("log_likelihood"))

