"""Operator 6, token files: Parquet list columns in ascending document order, read back selectively.

Documents are range-partitioned and sorted by id, encoded, closed with the end id and written one file per
partition: token ids as a list column (dictionary or delta encoded), row groups and pages of controlled size, page
indexes in every footer.  Metadata columns (id, length, place) are read without touching the token pages, and an id
range reads only the row groups and pages that hold it.

Defined results: a null or empty text is the end id alone; equal ids stand side by side, ordered by their text; a
null id comes first; an empty table gives an empty file set.
"""

from __future__ import annotations

import os
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replenix.llm.common import ship, texts
from replenix.llm.wordtable import LONGEST, WordTable, parts

_END_MARKS = ".,;:!?"   # marks that may end a run of letters
_WORDS = 2_400_000   # words remembered by a worker, and ids of them
_POOL = 16_000_000
_FRONT = 12_000       # frequent words looked up first
# Kinds of bytes: white space, end marks, letters a-z.
_SPACE, _MARK, _LETTER = (np.isin(np.arange(256), list(kind)) for kind in (
    b" \t\n\x0b\x0c\r", _END_MARKS.encode(), b"abcdefghijklmnopqrstuvwxyz"))


class Encoder:
    """Ids of whole texts by the tokenizers library, remembered per word.

    Valid for vocabularies that lower-case and whose pre-tokenizer never joins text across white space or across
    the end of a run of letters (the word vocabulary here): the ids of a text are then those of its words, in lower
    case (A-Z), one after the other, where a word ends at white space or before a mark that stands between a letter
    and white space.  Unknown runs of letters are encoded many at a time, by the library's model without its text
    normalization, which they do not need, and told apart by their word-end pieces.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs one worker per core
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.letters = Tokenizer(self.library.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.library.get_vocab_size(), dtype=bool)
        for piece, i in self.library.get_vocab().items():
            self.ends[i] = piece.endswith("</w>")
        self.end = np.array([end_id], dtype="<i4")
        self.marks: dict[str, np.ndarray] = {}
        self.table = WordTable()
        self._forget()

    def _forget(self) -> None:
        self.table.clear()
        self.long: dict[bytes, int] = {}                # words beyond the table's length, or with a zero byte
        self.pool = np.empty(1 << 16, dtype="<i4")      # ids of word after word
        self.place = np.zeros(1 << 14, dtype=np.int64)  # word n has pool[place[n]:place[n + 1]]
        self.words = self.batches = 0
        self._keep(self.end, np.array([1]))             # word 0 closes a text

    def encode(self, batch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id, one after the other; offsets of the texts)."""
        if self.table.count > _WORDS or self.place[self.words] > _POOL:
            self._forget()
        # strings of special tokens are told by their case, so such texts keep theirs
        joined = b"\n".join([b"", *(t.lower() if b"<|" not in t else t for t in batch), b" " * (LONGEST + 8)])
        data = np.frombuffer(joined, dtype=np.uint8)
        space = np.take(_SPACE, data)
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1   # the text begins and ends with white space
        starts, ends = edges[::2], edges[1::2]
        # a mark between a letter and white space is a word of its own
        cut = np.flatnonzero(np.take(_MARK, data[ends - 1]) & np.take(_LETTER, data[ends - 2]) & (ends - starts > 1))
        marks = ends[cut] - 1
        starts = np.insert(starts, cut + 1, marks)
        ends = np.insert(ends, cut, marks)
        last = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in batch]) + 1)   # words before each text's end
        numbers = np.insert(self._numbers(joined, data, starts, ends), last, 0)
        first = self.place[numbers]
        sizes = self.place[numbers + 1] - first
        offsets = np.cumsum(np.r_[0, sizes])
        at = np.repeat((first - offsets[:-1]).astype(np.int32), sizes)
        at += np.arange(offsets[-1], dtype=np.int32)
        return np.take(self.pool, at), offsets[np.r_[0, last + np.arange(1, len(batch) + 1)]]

    def _numbers(self, joined: bytes, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sizes = ends - starts
        fits = sizes <= LONGEST
        if b"\0" in joined:   # the table pads words with zeros, so a word that holds one is told by its bytes
            fits[np.searchsorted(starts, np.flatnonzero(data == 0), side="right") - 1] = False
        short = np.flatnonzero(fits)
        words = parts(data, starts[short], sizes[short])
        found = self.table.find(words)
        unknown = np.flatnonzero(found == 0)
        numbers = np.empty(len(starts), dtype=np.int64)
        if len(unknown):
            new = [w[unknown] for w in words]
            order = np.lexsort(new)
            change = np.zeros(len(order), dtype=bool)
            change[0] = True
            for w in new:
                w = w[order]
                change[1:] |= w[1:] != w[:-1]
            heads = unknown[order[change]]
            at = short[heads]
            texts_ = [joined[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            plain = np.array([t.isalpha() and t.islower() for t in texts_], dtype=bool)
            fresh = np.empty(len(heads), dtype=np.int64)
            for which, learn in ((plain, self._learn_plain), (~plain, self._learn)):
                fresh[which] = learn([texts_[k] for k in np.flatnonzero(which)])
            self.table.add([w[heads] for w in words], fresh)
            found[unknown[order]] = fresh[np.cumsum(change) - 1]
        numbers[short] = found
        self.batches += 1
        if self.batches in (1, 10, 100):   # the words seen most in this batch, the most frequent last
            seen = np.bincount(found)
            often = np.argsort(seen, kind="stable")[-_FRONT:]
            place = np.zeros(len(seen), dtype=np.int64)
            place[found] = np.arange(len(found))
            often = place[often[seen[often] > 1]]
            self.table.prefer([w[often] for w in words], found[often])
        rest = np.flatnonzero(~fits).tolist()
        if rest:
            found_ = [joined[starts[k]:ends[k]] for k in rest]
            new_words = list({t for t in found_ if t not in self.long})
            self.long.update(zip(new_words, self._learn(new_words).tolist()))
            numbers[rest] = [self.long[t] for t in found_]
        return numbers

    def _keep(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Numbers of new words, whose ids lie one after the other."""
        first, begin = self.words, int(self.place[self.words])
        self.words += len(sizes)
        while len(self.place) <= self.words + 1:
            self.place = np.concatenate([self.place, np.zeros_like(self.place)])
        while len(self.pool) < begin + len(ids):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.place[first + 1:self.words + 1] = begin + np.cumsum(sizes)
        self.pool[begin:begin + len(ids)] = ids
        return np.arange(first, self.words)

    def _learn_plain(self, words: list[bytes]) -> np.ndarray:
        """Numbers of new words of the letters a-z."""
        return self._keep(*self._runs(b" ".join(words).decode(), len(words), words))

    def _learn(self, words: list[bytes]) -> np.ndarray:
        """Numbers of new words of any kind."""
        out = np.empty(len(words), dtype=np.int64)
        runs, run_at, others, other_at = [], [], [], []
        for k, word in enumerate(words):
            text = word.decode("utf-8", "replace")
            run = text.rstrip(_END_MARKS)
            plain = run if word.isascii() else _lowered(run)
            if plain and plain.isalpha() and plain.islower():
                runs.append(plain)
                if run == text:
                    run_at.append(k)
                else:   # letters, then marks
                    run_at.append(-1 - len(others))
                    others.append(text[len(run):])
                    other_at.append(k)
            else:
                others.append(text)
                other_at.append(k)
        ids, sizes = self._runs(" ".join(runs), len(runs), runs)
        run_at_ = np.array(run_at, dtype=np.int64)
        whole = run_at_ >= 0
        other_ids: list = [None] * len(others)
        rest = [j for j in range(len(others))]
        if not whole.all():
            ends = np.cumsum(sizes)
            for r in np.flatnonzero(~whole).tolist():
                j = -1 - run_at[r]
                other_ids[j] = np.concatenate([ids[ends[r] - sizes[r]:ends[r]], self._marks(others[j])])
            rest = [j for j in rest if other_ids[j] is None]
            ids, sizes = ids[np.repeat(whole, sizes)], sizes[whole]
        out[run_at_[whole]] = self._keep(ids, sizes)
        for j, i in zip(rest, self._ids([others[j] for j in rest])):
            other_ids[j] = i
        if others:
            out[other_at] = self._keep(np.concatenate(other_ids), np.array([len(i) for i in other_ids]))
        return out

    def _runs(self, joined: str, n: int, runs: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``n`` runs of letters one after the other, and how many each has."""
        if not n:
            return np.empty(0, dtype="<i4"), np.empty(0, dtype=np.int64)
        found = self.letters.encode_batch_fast([joined], add_special_tokens=False)[0]
        ids = np.array(found.ids, dtype="<i4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != n or cuts[-1] != len(ids):   # not seen so far; then one by one
            each = self._ids([r if isinstance(r, str) else r.decode() for r in runs])
            return np.concatenate(each), np.array([len(i) for i in each])
        return ids, np.diff(cuts, prepend=0)

    def _marks(self, marks: str) -> np.ndarray:
        if marks not in self.marks:
            if len(self.marks) > 10_000:
                self.marks.clear()
            self.marks[marks] = self._ids([marks])[0]
        return self.marks[marks]

    def _ids(self, texts_: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts_, add_special_tokens=False) if texts_ else []
        return [np.array(e.ids, dtype="<i4") for e in found]


def _lowered(text: str) -> str:
    """Composed and in lower case as the vocabulary's normalization has it; "" where that depends on more."""
    return "" if "Σ" in text or "İ" in text else unicodedata.normalize("NFC", text).lower()


_encoders: dict[tuple[str, int], Encoder] = {}   # of this worker


def encoded(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents in id order over ascending partitions: doc_id, part, part_start, n_tokens, tokens.

    ``part_start`` counts the ids of the partition's earlier documents.
    """
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("part", T.IntegerType()),
                           T.StructField("part_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("tokens", T.ArrayType(T.IntegerType(), False))])

    def encode(batches):
        encoder = _encoders.get((path, end_id))
        if encoder is None:
            encoder = _encoders[path, end_id] = Encoder(path, end_id)
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            values, offsets = encoder.encode(texts(batch))
            yield pa.record_batch(
                [batch.column(0), pa.array(np.full(len(offsets) - 1, part, dtype="i4")), pa.array(start + offsets[:-1]),
                 pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(offsets.astype("i4")), pa.array(values))],
                names=schema.names)
            start += int(offsets[-1])

    ordered = (docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    return ordered.mapInArrow(encode, schema)


def write(docs: DataFrame, folder: str, path: str, end_id: int, encoding: str = "dictionary",
          row_group_bytes: int = 16 << 20, page_rows: int = 2_000, **columns) -> None:
    """Token files of ``docs`` in ``folder``; ``encoding`` is "dictionary" or "delta"."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")
    dictionary = encoding == "dictionary"
    (encoded(docs, path, end_id, **columns).write
     .option("compression", "zstd")
     .option("parquet.enable.dictionary", str(dictionary).lower())
     .option("parquet.writer.version", "PARQUET_1_0" if dictionary else "PARQUET_2_0")
     .option("parquet.block.size", str(row_group_bytes))
     .option("parquet.page.row.count.limit", str(page_rows))
     .parquet(folder))


def read(spark: SparkSession, folder: str, doc_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens and tokens of the files; ``start`` counts the ids of all documents before.

    The places of the files come from their metadata columns alone: one row per file is summed up.
    """
    files = spark.read.schema(
        f"doc_id {doc_type}, part int, part_start bigint, n_tokens bigint, tokens array<int>").parquet(folder)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("place"))
    return files.join(F.broadcast(places), "part").select(   # 12 bytes per file
        "doc_id", (F.col("place") + F.col("part_start")).alias("start"), "n_tokens", "tokens")


def digests(files: DataFrame, tokens: bool = True) -> DataFrame:
    """``files`` (as read) with ids_crc32: unsigned crc32 of the ids as little-endian unsigned 32-bit integers.

    Without ``tokens`` the ids go no further than the checksum.
    """
    kept = [f for f in files.schema.fields if tokens or f.name != "tokens"]
    schema = T.StructType([*kept, T.StructField("ids_crc32", T.LongType())])
    at, others = files.columns.index("tokens"), [files.columns.index(f.name) for f in kept]

    def digest(batches):
        for batch in batches:
            lists = batch.column(at)
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<i4")).cast("B")
            ends = lists.offsets.to_numpy()
            crcs = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.record_batch([*(batch.column(k) for k in others), pa.array(crcs, pa.int64())], names=schema.names)

    return files.mapInArrow(digest, schema)
