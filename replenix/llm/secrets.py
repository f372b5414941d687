"""Operator 5, secret scans: a trigram inverted index narrows the texts that each rule's regex has to read.

From the parsed regex of a rule comes a Boolean query over trigrams that every match must contain (letters folded
to lower case).  Each block of documents is indexed once: the trigrams any rule asks for, with the postings of the
block's documents.  A rule's query intersects and unites postings; only the candidates are matched by the regex.
A rule without mandatory trigrams reads every text.

Defined results: null and empty texts have no spans; overlapping spans of different kinds are all reported; within
a kind matches are leftmost and do not overlap; repeated rows are scanned alike.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_MOST = 64   # strings that a part of a regex may stand for before its trigrams are taken


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules.  {16,} finds the runs of 16 and more among the matches of [0-9a-f]+.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
# Public formats of further secrets.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("url", r"://[^\s/:@]{1,64}:[^\s/:@]{1,64}@"),
)


# A query is True (any text), a trigram, or ("and" | "or", frozenset of queries).

def _join(kind: str, queries) -> object:
    parts = set()
    for q in queries:
        if q is True:
            if kind == "or":
                return True
        elif isinstance(q, tuple) and q[0] == kind:
            parts |= q[1]
        else:
            parts.add(q)
    if not parts:
        return True
    return parts.pop() if len(parts) == 1 else (kind, frozenset(parts))


def _trigrams(strings: set[str]) -> object:
    """Query of a text that contains at least one of the strings."""
    return _join("or", [_join("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in strings])


def trigram_query(pattern: str) -> object:
    """Boolean trigram query that every text with a match of ``pattern`` satisfies."""
    exact, query = _walk(sre_parser.parse(pattern, re.ASCII))
    return _join("and", [query, _trigrams(exact) if exact is not None else True])


def _walk(nodes) -> tuple[set[str] | None, object]:
    """(the lower-case strings that the nodes can match, if few; query of what they demand besides)."""
    exact, whole, queries = {""}, True, []
    for op, arg in nodes:
        part, query = _node(op, arg)
        queries.append(query)
        if part is not None and len(part) * len(exact) <= _MOST:
            exact = {a + b for a in exact for b in part}
        else:   # the strings end here; others may begin with this node
            queries.append(_trigrams(exact))
            exact, whole = part or {""}, False
    if whole:
        return exact, _join("and", queries)
    return None, _join("and", [*queries, _trigrams(exact)])


def _node(op, arg) -> tuple[set[str] | None, object]:
    if op is sre.LITERAL:
        return ({chr(arg).lower()}, True) if arg < 128 else (None, True)
    if op is sre.IN:
        chars = set()
        for kind, value in arg:
            if kind is sre.LITERAL and value < 128:
                chars.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < 8 and value[1] < 128:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None, True
        return (chars, True) if len(chars) <= 8 else (None, True)
    if op is sre.SUBPATTERN:
        return _walk(arg[3])
    if op is sre.BRANCH:
        parts = [_walk(p) for p in arg[1]]
        if all(e is not None for e, _ in parts) and sum(len(e) for e, _ in parts) <= _MOST:
            return set().union(*(e for e, _ in parts)), _join("or", [q for _, q in parts])
        return None, _join("or", [_join("and", [q, _trigrams(e) if e is not None else True]) for e, q in parts])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, body = arg
        part, query = _walk(body)
        if most == 1 and least == 0:
            return (part | {""}, True) if part is not None and query is True else (None, True)
        if least == 0:
            return None, True
        if part is not None and least == most and len(part) == 1:
            return {s * least for s in part}, query
        return None, _join("and", [query, _trigrams(part) if part is not None else True])
    if op is sre.AT:
        return {""}, True
    return None, True


class Block:
    """Inverted index of a block of texts: for every wanted trigram the sorted numbers of the texts that hold it."""

    def __init__(self, texts: list[bytes], wanted: np.ndarray):
        self.all = np.arange(len(texts))
        joined = np.frombuffer(b"\n\n\n".join(texts).lower(), dtype=np.uint8)
        self.postings: dict[int, np.ndarray] = {}
        if len(joined) < 3:
            return
        codes = (joined[:-2].astype(np.int32) << 16) | (joined[1:-1].astype(np.int32) << 8) | joined[2:]
        at = np.flatnonzero(wanted[codes])
        starts = np.cumsum([0] + [len(t) + 3 for t in texts])[:-1]
        pairs = np.unique((codes[at].astype(np.int64) << 32) | (np.searchsorted(starts, at, side="right") - 1))
        grams, first = np.unique(pairs >> 32, return_index=True)
        for gram, docs in zip(grams.tolist(), np.split(pairs & 0xFFFFFFFF, first[1:])):
            self.postings[gram] = docs

    def candidates(self, query) -> np.ndarray:
        if query is True:
            return self.all
        if isinstance(query, str):
            return self.postings.get(_code(query), self.all[:0])
        found = sorted((self.candidates(q) for q in query[1]), key=len)
        out = found[0]
        for other in found[1:]:
            out = np.intersect1d(out, other) if query[0] == "and" else np.union1d(out, other)
        return out


def _code(gram: str) -> int:
    a, b, c = gram.encode("latin-1")
    return a << 16 | b << 8 | c


def _grams(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(_grams(q) for q in query[1]))


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(r.pattern, re.ASCII), trigram_query(r.pattern)) for r in rules]
        self.wanted = np.zeros(1 << 24, dtype=bool)
        for _, _, query in self.rules:
            for gram in _grams(query):
                self.wanted[_code(gram)] = True

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """(kind, start, end) of every text by start, then kind as listed; code points, end exclusive."""
        block = Block([t.encode("utf-8", "surrogatepass") for t in texts], self.wanted)
        found: list[list[tuple[int, int, str, int]]] = [[] for _ in texts]
        for order, (rule, regex, query) in enumerate(self.rules):
            for i in block.candidates(query).tolist():
                for m in regex.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[i].append((m.start(), order, rule.kind, m.end()))
        return [[(kind, start, end) for start, _, kind, end in sorted(f)] for f in found]


_scanners: dict[tuple, Scanner] = {}   # of this worker


def secret_spans(text: Column, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> Column:
    """array<struct<kind, start, end>> of the secrets of a text."""
    @F.pandas_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def scan(texts: pd.Series) -> pd.Series:
        if rules not in _scanners:
            _scanners[rules] = Scanner(rules)
        found = _scanners[rules].spans(list(texts))
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in f] for f in found])

    return scan(F.coalesce(text, F.lit("")))
