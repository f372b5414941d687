"""Operator 3, toxicity: nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Terms are words (lower case, outer marks stripped) and their beginnings of 4 to 6 characters.  From a bounded,
stratified sample of labelled documents come the vocabulary (terms whose document frequency differs between the
labels, by a chi-square test), the inverse document frequencies and the examples.  All other words together are one
more term, so that a cosine tells how much of a text the vocabulary makes up.  Examples lie in blocks; for
every term and block the index keeps the largest weight, so a query skips each block whose bound cannot reach the
k-th best cosine found so far, and the neighbours are exact.  Their distance-weighted votes are calibrated on
examples held back from the index; the nearest examples are the evidence.

Defined results: null and empty texts have no neighbour and get the score of the calibrated prior; ties in cosine go to the smaller example id; without labelled rows of both kinds the score is the
share of toxic labels (0.0 without any).
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenix.llm.common import BoundedCache, ship

_MARKS = b".,;:!?\"'()[]{}*#$%&|<>-"
_CACHE = 300_000


@dataclass(frozen=True)
class Fit:
    """Bounds of the labelled sample and parameters of the neighbour search."""

    per_label: int = 2_500    # labelled documents of each label
    held_back: float = 0.3    # share of them that calibrates the votes
    chi_square: float = 11.0
    min_documents: int = 3
    max_terms: int = 4_096
    neighbours: int = 15
    block: int = 64
    seed: int = 11


def _terms_of(word: bytes) -> tuple[bytes, ...]:
    """Terms of one word: itself and its beginnings of 4 to 6 characters (a beginning ends with a star)."""
    core = word.strip(_MARKS)
    if not core:
        return ()
    chars = core.decode("utf-8", "replace")
    return (core, *(chars[:n].encode() + b"*" for n in (4, 5, 6) if len(chars) > n))


def _counts(text: bytes, known) -> Counter:
    """Occurrences of terms; ``known(word)`` gives the term numbers of a word."""
    out: Counter = Counter()
    for terms, n in Counter(map(known, text.lower().split())).items():
        for t in terms:
            out[t] += n
    return out


class BlockMaxIndex:
    """Exact k nearest unit vectors by cosine.

    Postings lie term by term, each term's by example, so that those of (term, block) are one slice.  ``most``
    holds the largest weight of every such slice: with the query's weights it bounds the cosines of a block.
    """

    def __init__(self, vectors: list[dict[int, float]], n_terms: int, block: int):
        self.n, self.block = len(vectors), block
        n_blocks = -(-self.n // block)
        entries = sorted((t, i, x) for i, v in enumerate(vectors) for t, x in v.items())
        terms = np.array([t for t, _, _ in entries], dtype=np.int64)
        self.ids = np.array([i for _, i, _ in entries], dtype=np.int64)
        self.weights = np.array([x for _, _, x in entries])
        places = terms * n_blocks + self.ids // block
        edges = np.arange(n_terms * n_blocks + 1)
        self.cut = np.searchsorted(places, edges)
        self.most = np.zeros(n_terms * n_blocks)
        np.maximum.at(self.most, places, self.weights)
        self.most = self.most.reshape(n_terms, n_blocks)

    def nearest(self, query: dict[int, float], k: int) -> list[tuple[float, int]]:
        """(cosine, example) of the k best, highest first, ties by example; examples sharing no term are left out."""
        if not query or not self.n:
            return []
        terms, weights = np.fromiter(query, dtype=np.int64), np.fromiter(query.values(), dtype=float)
        bounds = weights @ self.most[terms]
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        n_blocks, at, step = self.most.shape[1], 0, 8
        ids, scores = np.empty(0, dtype=np.int64), np.empty(0)
        while at < len(order):
            if len(ids) == k and bounds[order[at]] < scores[-1] - 1e-9:
                break   # no further block can hold one of the k best
            places = (terms[:, None] * n_blocks + order[at:at + step]).ravel()
            lo = self.cut[places]
            size = self.cut[places + 1] - lo
            ends = np.cumsum(size)
            found = np.repeat(lo - ends + size, size) + np.arange(ends[-1])
            each = np.repeat(np.repeat(weights, len(places) // len(terms)), size)
            sums = np.bincount(self.ids[found], weights=self.weights[found] * each, minlength=self.n)
            new = np.flatnonzero(sums)
            ids, scores = np.concatenate([ids, new]), np.concatenate([scores, sums[new]])
            best = np.lexsort((ids, -np.round(scores, 12)))[:k]
            ids, scores = ids[best], scores[best]
            at, step = at + step, 4 * step
        return list(zip(scores.tolist(), ids.tolist()))


class Model:
    """Vocabulary, index and calibration fitted on the sample; picklable, of bounded size."""

    def __init__(self, sample: list[tuple[int, bytes, int]], shares: tuple[float, float], fit: Fit):
        """``sample``: (id, text, label); ``shares``: labelled rows each sampled row of label 0 and 1 stands for."""
        self.fit, self.shares = fit, shares
        rng = np.random.default_rng(fit.seed)
        sample = sorted(sample)
        order = rng.permutation(len(sample))
        held = set(order[: int(len(sample) * fit.held_back)].tolist())
        self.terms, self.idf = self._vocabulary(sample)
        self.words = None
        kept = [s for i, s in enumerate(sample) if i not in held]
        # alike examples in one block, so that its bounds are tight
        vectors = [self.vector(t) for _, t, _ in kept]
        order = sorted(range(len(kept)), key=lambda k: (kept[k][2], sorted((-x, t) for t, x in vectors[k].items())[:2]))
        self.examples = [(kept[k][0], kept[k][2]) for k in order]
        self.index = BlockMaxIndex([vectors[k] for k in order], len(self.terms) + 1, fit.block)
        total = [shares[y] * sum(1 for s in sample if s[2] == y) for y in (0, 1)]
        self.prior = total[1] / max(sum(total), 1e-9)
        self.slope, self.offset = 1.0, 0.0
        calibrating = [sample[i] for i in sorted(held)]
        if len({y for _, _, y in calibrating}) == 2:
            self._calibrate(np.array([self.vote(self.neighbours(t)) for _, t, _ in calibrating]),
                            np.array([y for _, _, y in calibrating]), np.array([shares[y] for _, _, y in calibrating]))

    def _vocabulary(self, sample) -> tuple[dict[bytes, int], np.ndarray]:
        n, df = [0, 0], [Counter(), Counter()]
        for _, text, y in sample:
            n[y] += 1
            df[y].update({t for w in set(text.lower().split()) for t in _terms_of(w)})
        scored = []
        for term, c in (df[0] + df[1]).items():
            if c >= self.fit.min_documents and n[0] and n[1]:
                a, b = df[1][term], df[0][term]
                total, miss = n[0] + n[1], n[0] + n[1] - c
                chi = total * (a * (n[0] - b) - b * (n[1] - a)) ** 2 / max(c * miss * n[0] * n[1], 1)
                if chi >= self.fit.chi_square:
                    scored.append((-chi, term, c))
        scored = sorted(scored)[: self.fit.max_terms]
        # frequencies as in the labelled rows, not as in the stratified sample
        size = n[0] * self.shares[0] + n[1] * self.shares[1]
        idf = [math.log((1 + size) / (1 + df[0][t] * self.shares[0] + df[1][t] * self.shares[1])) + 1
               for _, t, _ in scored]
        return {t: i for i, (_, t, _) in enumerate(scored)}, np.array([*idf, 1.0])

    def _known(self, word: bytes) -> tuple[int, ...]:
        """Terms of a word; words outside the vocabulary are all the last term."""
        return tuple(self.terms[t] for t in _terms_of(word) if t in self.terms) or (len(self.terms),)

    def vector(self, text: bytes) -> dict[int, float]:
        if self.words is None:
            self.words = BoundedCache(self._known, _CACHE)
        counts = _counts(text, self.words.__getitem__)
        raw = {t: math.sqrt(n) * self.idf[t] for t, n in sorted(counts.items())}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {t: x / norm for t, x in raw.items()}

    def __getstate__(self):
        return self.__dict__ | {"words": None}

    def neighbours(self, text: bytes) -> list[tuple[float, int]]:
        return self.index.nearest(self.vector(text), self.fit.neighbours)

    def vote(self, found: list[tuple[float, int]]) -> float:
        """Toxic share among the neighbours, weighted by nearness; a fixed weight of 0.5 speaks for the prior."""
        weigh = [(s / (1.02 - min(s, 1.0)), self.examples[i][1]) for s, i in found]
        return (0.5 * self.prior + sum(w * y for w, y in weigh)) / (0.5 + sum(w for w, _ in weigh))

    def score(self, vote) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * _logit(np.asarray(vote, dtype=float)) + self.offset, -30, 30)))

    def _calibrate(self, votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        """Logistic calibration (Newton steps with a small ridge towards slope 1)."""
        x = np.stack([_logit(votes), np.ones(len(votes))], axis=1)
        w, weights = np.array([1.0, 0.0]), weights / weights.mean()
        ridge = np.diag([1.0, 1e-2])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (weights * (p - labels)) + ridge @ (w - np.array([1.0, 0.0]))
            hess = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge
            step = np.linalg.solve(hess, grad)
            w = w - np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.offset = max(float(w[0]), 1e-3), float(w[1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit(docs: DataFrame, labels: DataFrame, params: Fit = Fit(), key: str = "doc_id", text: str = "text",
        label: str = "toxic") -> Model:
    """A model from at most about ``per_label`` labelled documents of each label, drawn by a hash of the id.

    ``labels`` must hold only rows that may be learned from.  A labelled id whose text is missing teaches nothing.
    """
    rows = labels.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("int").alias("y"))
    rows = rows.where("k is not null and y in (0, 1)").distinct()
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    share = {y: min(1.0, params.per_label / max(counts.get(y, 0), 1)) for y in (0, 1)}
    limit = F.when(F.col("y") == 1, F.lit(share[1])).otherwise(F.lit(share[0])) * (1 << 30)
    drawn = rows.where(F.pmod(F.xxhash64("k", F.lit(params.seed)), F.lit(1 << 30)) < limit)
    found = (docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).where("t is not null")
             .join(F.broadcast(drawn), "k").select("k", "t", "y"))   # the drawn ids are bounded by ``per_label``
    sample = [(r["k"], r["t"].encode(), r["y"]) for r in found.collect()]
    return Model(sample, (1 / share[0], 1 / share[1]), params)


_models: dict[str, Model] = {}   # of this worker


def toxicity(text: Column, model: Model, spark) -> Column:
    """struct<score, evidence> of whole texts; evidence holds the nearest examples with cosine and label."""
    ship(spark)
    data = pickle.dumps(model)
    shared, key = spark.sparkContext.broadcast(data), hashlib.sha256(data).hexdigest()

    @F.pandas_udf("score double, evidence array<struct<example:bigint,cosine:double,toxic:int>>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        if key not in _models:
            _models.clear()
            _models[key] = pickle.loads(shared.value)
        m = _models[key]
        found = [m.neighbours(t.encode("utf-8", "surrogatepass")) for t in texts]
        evidence = [[{"example": m.examples[i][0], "cosine": s, "toxic": m.examples[i][1]} for s, i in f[:3]]
                    for f in found]
        return pd.DataFrame({"score": m.score([m.vote(f) for f in found]) if found else [], "evidence": evidence})

    return predict(F.coalesce(text, F.lit("")))
