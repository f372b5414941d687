"""Operator 9, benchmark decontamination: Wu-Manber search of whole texts for the word windows of test items.

Texts and items are lower-cased (A-Z) and reduced to words joined by single blanks.  The windows of an item (ten
consecutive words; an item of fewer words is one window) are the patterns.  Per class of pattern lengths, a shift
table tells for the block of bytes under the window's end how far the search may jump; where it says 0, the bucket
of the block's hash names the patterns to compare byte by byte.  The search runs over many stretches of a batch at
once (numpy), each with its own position.

Items are a query set of any size: they are taken in blocks of bounded bytes, each broadcast and searched in a
pass of its own over the documents, whose hits are carried along with the row.

Defined results: null or wordless texts have no words and no hits; an item without words has no window; an empty
benchmark leaves every document clean; equal windows of several items count for each of them; an item whose id is
null marks words but is not listed; repeated rows are each judged alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replenix.llm.common import in_row, ship, texts

WINDOW = 10
BLOCK_BYTES = 2_000_000   # text of the items searched for in one pass
_BLOCK = 12               # bytes of a block of the shift table, if the patterns are that long
_BITS = 17
_STRETCH = 4096           # bytes scanned by one position
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
# Bytes that belong to words (digits, letters, everything beyond ASCII); A-Z become a-z.
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def normalized(text: bytes) -> bytes:
    """Words of ``text`` in lower case, each between blanks; b"" without words."""
    words = text.translate(_WORDS).split()
    return b" " + b" ".join(words) + b" " if words else b""


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    words = text.translate(_WORDS).split()
    if not words:
        return []
    return [b" " + b" ".join(words[i:i + size]) + b" " for i in range(max(1, len(words) - size + 1))]


class WuManber:
    """Multi-pattern search; patterns are grouped by length so that one short pattern does not shorten all jumps."""

    def __init__(self, patterns: list[bytes]):
        groups: dict[int, list[int]] = {}
        for i, p in enumerate(patterns):
            groups.setdefault(len(p).bit_length(), []).append(i)
        self.patterns = patterns
        self.tables = [self._table(ids) for ids in groups.values()]

    def _table(self, ids: list[int]) -> tuple:
        shortest = min(len(self.patterns[i]) for i in ids)
        block = min(_BLOCK, shortest)
        longest = min(shortest - block + 1, 255)
        shift = np.full(1 << _BITS, longest, dtype=np.uint8)
        heads = np.frombuffer(b"".join(self.patterns[i][:shortest] for i in ids), dtype=np.uint8)
        first = np.arange(len(ids), dtype=np.int64) * shortest
        for end in range(block - 1, shortest):
            np.minimum.at(shift, _hash(heads, first + end, block), min(shortest - 1 - end, 255))
        buckets: dict[int, list[int]] = {}
        for i, h in zip(ids, _hash(heads, first + shortest - 1, block).tolist()):
            buckets.setdefault(h, []).append(i)
        return shortest, block, shift, buckets

    def search(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(start, pattern number) of every occurrence in ``text``."""
        data = np.frombuffer(text, dtype=np.uint8)
        for shortest, block, shift, buckets in self.tables:
            ends = np.arange(0, len(data), _STRETCH, dtype=np.int64)
            limits = np.minimum(ends + _STRETCH, len(data))
            ends = np.maximum(ends, shortest - 1)
            while True:
                alive = ends < limits
                if not alive.all():
                    ends, limits = ends[alive], limits[alive]
                if not len(ends):
                    break
                hashes = _hash(data, ends, block)
                jump = shift[hashes]
                for at in np.flatnonzero(jump == 0).tolist():
                    start = int(ends[at]) - shortest + 1
                    for i in buckets.get(int(hashes[at]), ()):
                        if text.startswith(self.patterns[i], start):
                            yield start, i
                ends = ends + np.maximum(jump, 1)


def _hash(data: np.ndarray, ends: np.ndarray, block: int) -> np.ndarray:
    """Table places of the blocks of ``block`` bytes that end at ``ends``."""
    parts = np.zeros((len(ends), 16), dtype=np.uint8)
    parts[:, :block] = data[ends[:, None] + np.arange(1 - block, 1)]
    return ((parts.view(np.uint64) * _MIX).sum(axis=1, dtype=np.uint64) >> np.uint64(64 - _BITS)).astype(np.int64)


_searchers: dict[str, tuple] = {}   # of this worker: the tables of the last item block


def _searcher(key: str, items: list[tuple[str | None, bytes]]) -> tuple[WuManber, list[list[str]], list[int]]:
    if key not in _searchers:
        owners: dict[bytes, set] = {}
        for item, text in items:
            for w in windows(text):
                owners.setdefault(w, set()).add(item)
        patterns = sorted(owners)
        _searchers.clear()
        _searchers[key] = (WuManber(patterns), [sorted(i for i in owners[p] if i is not None) for p in patterns],
                           [p.count(b" ") - 1 for p in patterns])
    return _searchers[key]


def _found(search: tuple, found: list[bytes]) -> list[tuple[list[list[int]], set[str]]]:
    """Word intervals [first, end) and items of every normalized text."""
    machine, owners, lengths = search
    out: list[tuple[list[list[int]], set[str]]] = [([], set()) for _ in found]
    joined = b"\n".join(found)
    starts = np.cumsum([0] + [len(t) + 1 for t in found])[:-1]
    hits = list(machine.search(joined))
    if not hits:
        return out
    docs = np.searchsorted(starts, [h for h, _ in hits], side="right") - 1
    blanks: dict[int, np.ndarray] = {}
    for (at, i), d in sorted(zip(hits, docs.tolist())):
        if d not in blanks:
            blanks = {d: np.flatnonzero(np.frombuffer(found[d], dtype=np.uint8) == 0x20)}
        first = int(np.searchsorted(blanks[d], at - int(starts[d])))
        spans, items = out[d]
        items.update(owners[i])
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], first + lengths[i])
        else:
            spans.append([first, first + lengths[i]])
    return out


def _scan(key: str, shared, text: str):
    def scan(batches):
        search = _searcher(key, shared.value)
        for batch in batches:
            found = _found(search, [normalized(t) for t in texts(batch, text)])
            spans = [[*old, *new] for old, (new, _) in zip(batch.column(1).to_pylist(), found)]
            items = [sorted({*old, *new}) for old, (_, new) in zip(batch.column(2).to_pylist(), found)]
            yield pa.record_batch([batch.column(0), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                                   pa.array(items, pa.list_(pa.string()))], names=["row", "spans", "items"])
    return scan


def _item_blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """Items in blocks of about ``block_bytes`` of text each; the driver holds one block at a time."""
    items = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text"))
    items = items.where(F.col("text").isNotNull())
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-total // block_bytes)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        yield sorted(((r[0], r[1].encode()) for r in rows.toLocalIterator()), key=lambda r: (r[1], r[0] or ""))


def hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row`` (all columns of ``docs``), word intervals ``spans`` hit by item windows and the ``items`` found."""
    spark = docs.sparkSession
    ship(spark)
    empty = [F.array().cast(t) for t in ("array<array<bigint>>", "array<string>")]
    out = in_row(docs).select("row", empty[0].alias("spans"), empty[1].alias("items"))
    schema = T.StructType([out.schema["row"], T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    for b, block in enumerate(_item_blocks(benchmark, item, item_text, block_bytes)):
        key = f"{b}:{hashlib.sha256(repr(block).encode()).hexdigest()}"
        out = out.mapInArrow(_scan(key, spark.sparkContext.broadcast(block), text), schema)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``row`` plus n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    def report(batches):
        for batch in batches:
            counts = [len(t.translate(_WORDS).split()) for t in texts(batch, text)]
            spans, items = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            n_hit = [_covered(s) for s in spans]
            digests = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array([len(i) for i in items], pa.int64()), pa.array(digests), pa.array([n > 0 for n in n_hit])],
                names=schema.names)

    found = hits(docs, benchmark, text, **options)
    schema = T.StructType([found.schema["row"], *(T.StructField(c, T.LongType()) for c in ("n_words", "n_hit", "n_items")),
                           T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType())])
    return found.mapInArrow(report, schema)


def _covered(spans: list[list[int]]) -> int:
    total = end = 0
    for first, last in sorted(spans):
        total += max(0, last - max(first, end))
        end = max(end, last)
    return total


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any item window, with their own columns."""
    return hits(docs, benchmark, **options).where(F.size("spans") == 0).select("row.*")
