"""Operator 10, language identification: a bidirectional gated recurrent network over bytes.

The network reads runs of bytes between white space (longer ones in pieces of 24) from both ends, labels every byte
position with language probabilities, and a document's probabilities are the mean over all its positions.  It is
trained in numpy by backpropagation through time on a bounded sample of labelled documents, shipped to the
executors, and run over whole texts; runs of bytes seen of late are remembered with the sums of their labels.

Defined results: null text or text without a letter is ``und`` with score 0; without a single labelled row every
document is ``und``; very long texts are read whole; repeated rows get equal answers.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenix.llm.common import ship

PIECE = 24
_CACHE = 600_000     # byte runs remembered by a worker


@dataclass(frozen=True)
class Training:
    """Bounds of the training sample and of the training itself."""

    docs_per_language: int = 300       # drawn by a hash of the key
    chars_per_document: int = 1_400    # a stretch of each, its place drawn likewise, whatever its script
    runs_per_language: int = 12_000    # byte runs drawn from these
    hidden: int = 16
    epochs: int = 3
    batch: int = 256
    rate: float = 0.01
    seed: int = 7


def pieces(text: bytes) -> list[bytes]:
    runs = text.split()
    if runs and max(map(len, runs)) > PIECE:
        runs = [r[i:i + PIECE] for r in runs for i in range(0, len(r), PIECE)]
    return runs


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


class ByteGRU:
    """Two gated recurrent layers, left to right and right to left, and a softmax over languages per position."""

    def __init__(self, languages: list[str], hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        h, n = hidden, len(languages)
        self.w: dict[str, np.ndarray] = {}
        for d in "fb":
            self.w["x" + d] = rng.normal(0, 0.3, (256, 3 * h)).astype("f4")          # byte -> gates z, r, n
            self.w["u" + d] = rng.normal(0, h ** -0.5, (h, 3 * h)).astype("f4")
            self.w["c" + d] = np.zeros(h, dtype="f4")
        self.w["o"] = rng.normal(0, 0.1, (2 * h, n)).astype("f4")
        self.w["ob"] = np.zeros(n, dtype="f4")

    def key(self) -> str:
        parts = [repr(self.languages).encode(), *(self.w[k].tobytes() for k in sorted(self.w))]
        return hashlib.sha256(b"".join(parts)).hexdigest()

    def _steps(self, d: str, codes: list[np.ndarray], keep: list | None = None) -> list[np.ndarray]:
        """States after every step; ``codes[t]`` holds the bytes of the runs still alive at step t (longest first)."""
        x, u, c, h = self.w["x" + d], self.w["u" + d], self.w["c" + d], self.hidden
        state, out = np.zeros((len(codes[0]), h), dtype="f4"), []
        for code in codes:
            old = state[:len(code)]
            a, g = x[code], old @ u
            zr = _sigmoid(a[:, :2 * h] + g[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            q = g[:, 2 * h:] + c
            n = np.tanh(a[:, 2 * h:] + r * q)
            state = n + z * (old - n)
            out.append(state)
            if keep is not None:
                keep.append((code, old, z, r, q, n))
        return out

    @staticmethod
    def _columns(runs: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Order of the runs (longest first) and their bytes step by step, forwards and backwards."""
        lengths = np.array([len(r) for r in runs])
        order = np.argsort(-lengths, kind="stable")
        sizes = lengths[order]
        table = np.zeros((len(runs), sizes[0]), dtype=np.uint8)
        table[np.arange(sizes[0]) < sizes[:, None]] = np.frombuffer(b"".join([runs[i] for i in order]), dtype=np.uint8)
        alive = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
        forth = [table[:n, t] for t, n in enumerate(alive)]
        back = [table[np.arange(n), sizes[:n] - 1 - t] for t, n in enumerate(alive)]
        return order, forth, back

    def label(self, runs: list[bytes]) -> np.ndarray:
        """Sum over its positions of the language probabilities of every run."""
        order, forth, back = self._columns(runs)
        f, b = self._steps("f", forth), self._steps("b", back)
        sizes = np.array([len(runs[i]) for i in order])
        total = np.zeros((len(runs), len(self.languages)), dtype="f4")
        h = self.hidden
        b_all = np.zeros((len(f), len(runs), h), dtype="f4")
        for t, s in enumerate(b):   # the backward state at position p comes from step size - 1 - p
            b_all[sizes[:len(s)] - 1 - t, np.arange(len(s))] = s
        for t, s in enumerate(f):
            logits = s @ self.w["o"][:h] + b_all[t, :len(s)] @ self.w["o"][h:] + self.w["ob"]
            e = np.exp(logits - logits.max(axis=1, keepdims=True))
            total[:len(s)] += e / e.sum(axis=1, keepdims=True)
        out = np.empty_like(total)
        out[order] = total
        return out

    def gradients(self, runs: list[bytes], labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy per position and its gradients, by backpropagation through time."""
        order, forth, back = self._columns(runs)
        sizes, y = np.array([len(runs[i]) for i in order]), labels[order]
        kept: dict[str, list] = {"f": [], "b": []}
        f, b = self._steps("f", forth, kept["f"]), self._steps("b", back, kept["b"])
        h, n = self.hidden, int(sizes.sum())
        g = {k: np.zeros_like(v) for k, v in self.w.items()}
        df, db = [np.zeros_like(s) for s in f], [np.zeros_like(s) for s in b]
        loss = 0.0
        for t, s in enumerate(f):
            rows = np.arange(len(s))
            steps = sizes[:len(s)] - 1 - t
            other = np.empty_like(s)
            for k in np.unique(steps):
                at = steps == k
                other[at] = b[k][rows[at]]
            logits = s @ self.w["o"][:h] + other @ self.w["o"][h:] + self.w["ob"]
            e = np.exp(logits - logits.max(axis=1, keepdims=True))
            p = e / e.sum(axis=1, keepdims=True)
            loss -= float(np.log(p[rows, y[:len(s)]] + 1e-12).sum())
            p[rows, y[:len(s)]] -= 1
            p /= n
            g["o"][:h] += s.T @ p
            g["o"][h:] += other.T @ p
            g["ob"] += p.sum(axis=0)
            df[t] += p @ self.w["o"][:h].T
            dother = p @ self.w["o"][h:].T
            for k in np.unique(steps):
                at = steps == k
                db[k][rows[at]] += dother[at]
        for d, grads in (("f", df), ("b", db)):
            later = np.zeros_like(grads[0])
            for (code, old, z, r, q, m), ds in zip(reversed(kept[d]), reversed(grads)):
                ds = ds + later[:len(ds)]
                dn, dz = ds * (1 - z), ds * (old - m)
                da = dn * (1 - m * m)
                dq = da * r
                gates = np.concatenate([dz * z * (1 - z), da * q * r * (1 - r), dq], axis=1)
                inputs = np.concatenate([gates[:, :2 * h], da], axis=1)
                np.add.at(g["x" + d], code, inputs)
                g["u" + d] += old.T @ gates
                g["c" + d] += dq.sum(axis=0)
                later = np.zeros_like(grads[0])
                later[:len(ds)] = ds * z + gates @ self.w["u" + d].T
        return loss / n, g

    def train(self, runs: list[bytes], labels: np.ndarray, training: Training) -> "ByteGRU":
        rng = np.random.default_rng(training.seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        step = 0
        for epoch in range(training.epochs):
            order = rng.permutation(len(runs))
            rate = training.rate * 0.5 ** epoch
            for i in range(0, len(runs), training.batch):
                at = order[i:i + training.batch]
                _, grads = self.gradients([runs[k] for k in at], labels[at])
                step += 1
                for k, g in grads.items():   # Adam
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.01 * (g * g - v[k])
                    self.w[k] -= (rate * (m[k] / (1 - 0.9 ** step))
                                  / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype("f4")
        return self


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        training: Training = Training()) -> ByteGRU | None:
    """A network trained on about ``docs_per_language`` documents of each language, a stretch of ``chars_per_document``
    characters of each and at most ``runs_per_language`` byte runs of a language; None without labelled text.

    The sample is drawn by a hash of the key, so reruns agree; sizes are those of ``Training`` at every input size.
    """
    rows = labelled.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), F.col(f"`{lang}`").alias("l"))
    rows = rows.where("l is not null and t is not null")
    counts = {r["l"]: r["count"] for r in rows.groupBy("l").count().collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in counts.items()
                           for x in (k, min(1.0, training.docs_per_language / n))])
    drawn = F.pmod(F.xxhash64("k", F.lit(training.seed)), F.lit(1 << 30)) < share[F.col("l")] * (1 << 30)
    size = training.chars_per_document
    cut = f"substr(t, 1 + cast(pmod(xxhash64(k), greatest(length(t) - {size}, 1)) as int), {size})"
    sample = rows.where(drawn).select("k", "l", F.expr(cut).alias("t")).collect()
    languages = sorted(counts)
    rng = np.random.default_rng(training.seed)
    runs, labels = [], []
    for i, language in enumerate(languages):
        found = [p for r in sorted((r for r in sample if r["l"] == language), key=lambda r: str(r["k"]))
                 for p in pieces(r["t"].encode())]
        chosen = rng.permutation(len(found))[:training.runs_per_language]
        runs += [found[j] for j in chosen]
        labels += [i] * len(chosen)
    if not runs:
        return None
    return ByteGRU(languages, training.hidden, training.seed).train(runs, np.array(labels), training)


class Labeller:
    """Document probabilities, with the label sums of byte runs seen of late."""

    def __init__(self, network: ByteGRU):
        self.network = network
        self.place: dict[bytes, int] = {}
        self.sums = np.zeros((1 << 12, len(network.languages)), dtype="f4")

    def pooled(self, batch: list[bytes]) -> np.ndarray:
        """Mean language probabilities over all positions of every text (0 without any)."""
        split = [pieces(t) for t in batch]
        wanted = set().union(*split)
        if len(self.place) + len(wanted) > _CACHE:
            self.place.clear()
        missing = sorted(wanted.difference(self.place), key=len)
        for i in range(0, len(missing), 4096):
            part = missing[i:i + 4096]
            first = len(self.place)
            if first + len(part) > len(self.sums):
                self.sums = np.concatenate([self.sums, np.zeros((max(len(part), len(self.sums)), self.sums.shape[1]), "f4")])
            self.sums[first:first + len(part)] = self.network.label(part)
            self.place.update(zip(part, range(first, first + len(part))))
        out = np.zeros((len(batch), self.sums.shape[1]))
        for i, runs in enumerate(split):
            if runs:
                places = np.fromiter(map(self.place.__getitem__, runs), dtype=np.int64, count=len(runs))
                out[i] = self.sums[places].sum(axis=0, dtype=np.float64) / sum(map(len, runs))
        return out


_labellers: dict[str, Labeller] = {}   # of this worker, by the network's weights


def language(text: Column, network: ByteGRU | None, spark) -> Column:
    """struct<lang_pred, score> of whole texts."""
    ship(spark)
    if network is None:
        return F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared, key = spark.sparkContext.broadcast(network), network.key()

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        labeller = _labellers.get(key)
        if labeller is None:
            _labellers.clear()
            labeller = _labellers[key] = Labeller(shared.value)
        pooled = labeller.pooled([t.encode("utf-8", "surrogatepass") for t in texts])
        best = pooled.argmax(axis=1)
        named = np.array([any(map(str.isalpha, t)) for t in texts], dtype=bool)
        score = np.where(named, np.clip(pooled[np.arange(len(best)), best], 0.0, 1.0), 0.0)
        return pd.DataFrame({"lang_pred": [labeller.network.languages[b] if n else "und" for b, n in zip(best, named)],
                             "score": score})

    return predict(F.coalesce(text, F.lit("")))
