"""Numbers for short byte words, looked up for whole buffers at once (numpy open addressing).

A word of up to 24 bytes, none of them zero, is held as three 64-bit parts padded with zeros, so two words are equal
exactly if their parts are.
"""

from __future__ import annotations

import numpy as np

LONGEST = 24
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def parts(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The three parts of every word; ``data`` must go on for 24 bytes behind the last start."""
    eights = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    out = [eights[starts] & _MASKS[np.minimum(sizes, 8)]]
    for k in (8, 16):   # most words end within the first part
        longer, part = np.flatnonzero(sizes > k), np.zeros(len(starts), dtype=np.uint64)
        part[longer] = eights[starts[longer] + k] & _MASKS[np.minimum(sizes[longer] - k, 8)]
        out.append(part)
    return out


class WordTable:
    """Rows of three parts and a number (0: free), so that one look touches one stretch of memory.

    A small table in front holds the most frequent words, one per slot: it stays in the processor's cache.
    """

    def __init__(self, bits: int = 22, front_bits: int = 14):
        self.bits, self.size, self.front_bits = bits, 1 << bits, front_bits
        self.clear()

    def clear(self) -> None:
        self.rows = np.zeros((self.size, 4), dtype=np.uint64)
        self.front = [np.zeros(1 << self.front_bits, dtype=np.uint64) for _ in range(4)]
        self.count = 0

    def _hashes(self, words: list[np.ndarray]) -> np.ndarray:
        h = words[0] * _MIX[0] + words[1] * _MIX[1] + words[2] * _MIX[2]
        h ^= h >> np.uint64(32)
        return h * _MIX[0]

    def _slots(self, words: list[np.ndarray]) -> np.ndarray:
        return (self._hashes(words) >> np.uint64(64 - self.bits)).astype(np.int64)

    def prefer(self, words: list[np.ndarray], numbers: np.ndarray) -> None:
        """Puts the words into the small table; of two in one slot the later one stays."""
        slots = (self._hashes(words) >> np.uint64(64 - self.front_bits)).astype(np.int64)
        for column, values in zip(self.front, (*words, numbers)):
            column[slots] = values

    def find(self, words: list[np.ndarray]) -> np.ndarray:
        """Number of every word, 0 for unknown ones."""
        hashes = self._hashes(words)
        slots = (hashes >> np.uint64(64 - self.front_bits)).astype(np.int64)
        out = np.take(self.front[3], slots).astype(np.int64)
        for column, word in zip(self.front, words):
            out[np.take(column, slots) != word] = 0
        at = np.flatnonzero(out == 0)
        slots, words = (hashes[at] >> np.uint64(64 - self.bits)).astype(np.int64), [w[at] for w in words]
        while len(at):
            rows = np.take(self.rows, slots, axis=0)
            same = (rows[:, 0] == words[0]) & (rows[:, 1] == words[1]) & (rows[:, 2] == words[2])
            number = rows[:, 3].astype(np.int64)
            out[at] = np.where(same, number, 0)
            going = np.flatnonzero(~same & (number != 0))
            at, slots = at[going], (slots[going] + 1) & (self.size - 1)
            words = [w[going] for w in words]
        return out

    def add(self, words: list[np.ndarray], numbers: np.ndarray) -> None:
        """Distinct unknown words with their numbers (from 1)."""
        slots, at = self._slots(words), np.arange(len(numbers))
        rows = np.stack([*words, numbers.astype(np.uint64)], axis=1)
        while len(at):
            free = np.flatnonzero(self.rows[slots, 3] == 0)
            _, first = np.unique(slots[free], return_index=True)
            won = free[first]
            self.rows[slots[won]] = rows[at[won]]
            left = np.ones(len(at), dtype=bool)
            left[won] = False
            at, slots = at[left], (slots[left] + 1) & (self.size - 1)
        self.count += len(numbers)
