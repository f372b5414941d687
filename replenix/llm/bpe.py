"""Operator 2, token counts: byte-pair merging with a heap and a linked list, no identifiers emitted.

The text becomes one symbol per character, every blank a ``▁`` and one ``▁`` in front.  The adjacent pair whose
joined piece ranks lowest (ties: leftmost) is merged until none is left; the count is symbols minus merges, where a
character outside the vocabulary counts its UTF-8 bytes.  No piece of the vocabulary holds two neighbours across a
cut between segments, so whole texts are counted segment by segment and segments seen of late are remembered.

Defined results: null counts as empty; an empty text has 0 tokens; a text of any length is counted whole.
"""

from __future__ import annotations

import heapq
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from replenix.llm.common import BoundedCache

BLANK = "▁"
_CACHE = 300_000      # segments remembered by a worker, twice
_KEEP = 48            # longest segment remembered
_RUNS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


class PieceCounter:
    """Counts the pieces of a byte-fallback BPE vocabulary; pieces and scores come from the model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if any(model.is_unused(i) for i in ids):
            raise ValueError("vocabularies with unused pieces need re-splitting, which is not counted here")
        normal = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in normal}
        self.joined = {p[k:k + 2] for p in self.rank for k in range(len(p) - 1)}
        if any(a != BLANK and b == BLANK for a, b in self.joined):
            raise ValueError("the vocabulary joins a blank to what stands before it")
        self.parts = BoundedCache(self._merged, _CACHE)
        self.segments = BoundedCache(self._segment, _CACHE)

    def count(self, text: str) -> int:
        """Tokens of one whole text."""
        if not text:
            return 0
        if "  " in text or BLANK in text or text[0] == " ":
            segments = _RUNS.findall(BLANK + text.replace(" ", BLANK))
        else:
            segments = text.split(" ")
        return sum(map(self.segments.__getitem__, segments))

    def _segment(self, segment: str) -> int:
        """Tokens of a segment; one without leading blank sign stands for a word after one blank."""
        if segment[:1] != BLANK:
            segment = BLANK + segment
        joined, start, total = self.joined, 0, 0
        for end in range(1, len(segment) + 1):
            if end == len(segment) or segment[end - 1:end + 1] not in joined:
                part = segment[start:end]
                total += self.parts[part] if len(part) <= _KEEP else self._merged(part)
                start = end
        return total

    def _merged(self, part: str) -> int:
        rank, n = self.rank, len(part)
        total = sum(1 if c in rank else len(c.encode("utf-8", "surrogatepass")) for c in part)
        if n == 1:
            return total
        symbols: list[str] = list(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank.get(part[i:i + 2])
            if r is not None:
                heap.append((r, i, part[i:i + 2]))
        heapq.heapify(heap)
        while heap:
            _, i, piece = heapq.heappop(heap)
            j = after[i]
            if j >= n or not symbols[i] or symbols[i] + symbols[j] != piece:
                continue   # one of the two has been merged meanwhile
            total -= 1
            symbols[i], symbols[j] = piece, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                self._push(heap, i, piece + symbols[k])
            if before[i] >= 0:
                self._push(heap, before[i], symbols[before[i]] + piece)
        return total

    def _push(self, heap: list, i: int, piece: str) -> None:
        r = self.rank.get(piece)
        if r is not None:
            heapq.heappush(heap, (r, i, piece))


_counters: dict[str, PieceCounter] = {}   # of this worker


def token_count(text: Column, model_path: str) -> Column:
    """Number of tokens of ``text`` in the vocabulary at ``model_path`` (a path every executor can read)."""
    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        if model_path not in _counters:
            _counters[model_path] = PieceCounter(model_path)
        counter = _counters[model_path]
        return pd.Series([counter.count(t) for t in texts], dtype="int64")

    return count(F.coalesce(text, F.lit("")))
