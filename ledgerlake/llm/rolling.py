"""Rolling hashes over bytes or words, and content-chosen anchors.

Every window of ``window`` units holds a gram of ``gram`` units that its content alone chooses (the one
of least hash, leftmost on ties). Equal windows therefore choose the same gram at the same place, so
repeats are found by comparing the few chosen grams (anchors) and what surrounds them, not each window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ledgerlake.llm.common import mix

BASE = 0x9E3779B97F4A7C15 | 1
BLOCK = 1 << 19  # units hashed at once; longer texts go in overlapping blocks
_POS_BITS = 21
_POS = np.uint64((1 << _POS_BITS) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Tables:
    """Powers of the base and of its inverse, grown on demand and kept per worker."""

    n = 0

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if cls.n < n:
            cls.n = max(n, 1 << 16)
            cls.power = _powers(BASE, cls.n)
            cls.inverse = _powers(pow(BASE, -1, 2**64), cls.n)
        return cls.power, cls.inverse


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))

# White space of the word pattern [^\x20\x09-\x0D]+ (fixed values).
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Rolled:
    """Prefix sums that give the hash of any run of units in constant time."""

    def __init__(self, units: np.ndarray):
        self.n = len(units)
        self.power, self.inverse = _Tables.get(self.n + 1)
        self.prefix = np.zeros(self.n + 1, np.uint64)
        np.cumsum(units * self.power[:self.n], out=self.prefix[1:])

    def runs(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[begin]) * self.inverse[begin])

    def grams(self, k: int) -> np.ndarray:
        if self.n < k:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[k:] - self.prefix[:self.n + 1 - k]) * self.inverse[:self.n + 1 - k])


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end byte of every word of the texts, and the n + 1 offsets of each text's words."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    letter = ~SPACE[raw]
    fresh = letter.copy()
    fresh[1:] &= ~letter[:-1]
    inner = offsets[:-1][offsets[:-1] < len(raw)]
    fresh[inner] = letter[inner]  # a text begins a word of its own
    begin = np.flatnonzero(fresh)
    last = letter.copy()
    last[:-1] &= ~letter[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = letter[ends]
    end = np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(begin, offsets)


def word_units(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One 64-bit value per word."""
    return Rolled(BYTE_VALUES[raw]).runs(begin, end) + (end - begin).astype(np.uint64)


@dataclass
class Anchors:
    """Anchor j serves the windows ``first[j] .. first[j] + count[j] - 1``, which all hold gram ``at[j]``."""

    at: np.ndarray
    first: np.ndarray
    count: np.ndarray
    gram: np.ndarray
    span: np.ndarray


def anchors(rolled: Rolled, offsets: np.ndarray, gram: int, window: int) -> Anchors:
    """Anchors of all windows that lie within one text; ``offsets`` bound the texts in units."""
    hashes = rolled.grams(gram)
    per = window - gram + 1
    none = np.zeros(0, np.int64)
    if len(hashes) < per:
        return Anchors(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    least = (hashes & ~_POS) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while reach * 2 <= per:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < per:
        least = np.minimum(least[:len(least) - (per - reach)], least[per - reach:])
    chosen = (least & _POS).astype(np.int64)
    inside = np.zeros(len(chosen) + 1, np.int32)  # +1 where a text's windows begin, -1 after its last
    begin, stop = offsets[:-1], offsets[1:] - window + 1
    full = stop > begin
    np.add.at(inside, begin[full], 1)
    np.add.at(inside, stop[full], -1)
    valid = np.cumsum(inside[:-1]) > 0
    fresh = valid.copy()
    fresh[1:] &= (chosen[1:] != chosen[:-1]) | ~valid[:-1]
    # Windows of two texts in direct succession choose different grams, as each lies within its text.
    first = np.flatnonzero(fresh)
    if not len(first):
        return Anchors(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    total = np.cumsum(valid)
    count = np.diff(np.append(total[first] - 1, total[-1]))
    at = chosen[first]
    span = rolled.runs(first, first + count - 1 + window)
    span = mix(span + ((at - first).astype(np.uint64) << np.uint64(32)) + count.astype(np.uint64))
    return Anchors(at, first, count, hashes[at], span)
