"""Elias-Fano coded monotone sequences and the two-level trie of bigrams built from them."""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

_COUNT = np.array([bin(b).count("1") for b in range(256)], np.int64)
# _NTH_ZERO[byte, k]: place of the k-th zero bit of a byte.
_NTH_ZERO = np.full((256, 8), 8, np.int64)
_NTH_ONE = np.full((256, 8), 8, np.int64)
for _b in range(256):
    for _table, _bit in ((_NTH_ZERO, 0), (_NTH_ONE, 1)):
        _places = [i for i in range(8) if (_b >> i & 1) == _bit]
        _table[_b, : len(_places)] = _places


class Sequence:
    """``n`` sorted numbers below ``2**64``: low bits side by side, high bits in unary.

    ``parts()`` is what is stored; the counts per byte that a search needs are derived on opening.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = _COUNT[high]
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.concatenate([[0], np.cumsum(8 - ones)])

    @staticmethod
    def code(values: np.ndarray, universe: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        n = len(values)
        low_bits = min(max(0, (universe // max(n, 1)).bit_length() - 1), 56)
        bits = np.zeros(n * low_bits, np.uint8)
        for b in range(low_bits):
            bits[b::low_bits] = (values >> np.uint64(b) & np.uint64(1)).astype(np.uint8)
        low = np.concatenate([np.packbits(bits, bitorder="little"), np.zeros(8, np.uint8)])
        place = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros((int(place[-1]) if n else 0) + 9, np.uint8)
        unary[place] = 1
        return n, low_bits, low, np.packbits(unary, bitorder="little")

    def low_at(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), np.uint64)
        at = index * self.low_bits
        raw = np.ascontiguousarray(self.low[(at >> 3)[:, None] + np.arange(8)]).view("<u8").ravel()
        return raw >> (at & 7).astype(np.uint64) & np.uint64((1 << self.low_bits) - 1)

    def _select(self, k: np.ndarray, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Place of the ``k``-th bit of a kind, from 0."""
        byte = np.minimum(np.searchsorted(counts, k, "right") - 1, len(self.high) - 1)
        return byte * 8 + table[self.high[byte], np.minimum(k - counts[byte], 7)]

    def at(self, index: np.ndarray) -> np.ndarray:
        high = self._select(index, self.ones, _NTH_ONE) - index
        return high.astype(np.uint64) << np.uint64(self.low_bits) | self.low_at(index)

    def find(self, values: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Index of each value's successor, the first number not below it, within ``first:last``.

        The unary part leads to the few numbers with the same high bits, where low bits are
        searched by halving.
        """
        if not self.n:
            return np.zeros(len(values), np.int64)
        high = np.minimum((values >> np.uint64(self.low_bits)).astype(np.int64), int(self.zeros[-1]) - 1)
        before = self._select(np.maximum(high - 1, 0), self.zeros, _NTH_ZERO)
        lo = np.where(high > 0, before - np.maximum(high - 1, 0), 0)
        hi = np.minimum(self._select(high, self.zeros, _NTH_ZERO) - high, self.n)
        if first is not None:
            lo, hi = np.clip(lo, first, last), np.clip(hi, first, last)
        want = values & np.uint64((1 << self.low_bits) - 1)
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi) >> 1
            below = open_ & (self.low_at(np.minimum(mid, self.n - 1)) < want)
            lo = np.where(below, mid + 1, lo)
            hi = np.where(open_ & ~below, mid, hi)


def quantised(values: np.ndarray) -> tuple[float, float, np.ndarray]:
    """``start, step`` and one byte per value."""
    if not len(values):
        return 0.0, 1.0, np.zeros(0, np.uint8)
    start, step = float(values.min()), max(float(np.ptp(values)) / 255, 1e-9)
    return start, step, np.rint((values - start) / step).astype(np.uint8)


CONTEXT_BITS = 40


class BigramTrie:
    """Words with their contexts, in levels that lie one after another in a memory-mapped file.

    Level 1: sorted word keys, monotone counts (sums of the counts so far) and a byte each for the
    probability of the word in an unseen context. Level 2: monotone pointers to each word's first context,
    context keys made monotone by the place of their word, and a byte each for the probability in that
    context.
    """

    def __init__(self, words, counts, unseen, pointers, contexts, seen):
        file = tempfile.TemporaryFile()
        layout, at = [], 0
        for sequence in (words, counts, pointers, contexts):
            n, low_bits, low, high = sequence
            layout.append((n, low_bits, at, len(low), len(high)))
            file.write(low.tobytes() + high.tobytes())
            at += len(low) + len(high)
        self.scales = []
        for start, step, codes in (unseen, seen):
            self.scales.append((start, step, at, len(codes)))
            file.write(codes.tobytes())
            at += len(codes)
        file.flush()
        # The file has no name, so it is gone with the task.
        self.map = mmap.mmap(file.fileno(), max(at, 1), access=mmap.ACCESS_READ) if at else b""
        file.close()
        raw = np.frombuffer(self.map, np.uint8)
        self.size = at
        self.words, self.counts, self.pointers, self.contexts = (
            Sequence(n, low_bits, raw[a : a + x], raw[a + x : a + x + y]) for n, low_bits, a, x, y in layout
        )
        self.codes = [raw[a : a + n] for _, _, a, n in self.scales]

    @classmethod
    def build(cls, word, context, count, word_counts, value):
        """From sorted distinct ``(word, context)`` with counts; ``word_counts(words, sums)`` gives the
        count of each word and ``value(count in context, count of word)`` what is stored."""
        words, begin = np.unique(word, return_index=True)
        sums = np.add.reduceat(count, begin) if len(begin) else np.zeros(0, np.int64)
        totals = word_counts(words, sums)
        place = np.repeat(np.arange(len(words)), np.diff(np.append(begin, len(word))))
        relative = place.astype(np.uint64) << np.uint64(CONTEXT_BITS) | context
        code = Sequence.code
        return cls(
            code(words, 1 << 56),
            code(np.cumsum(totals).astype(np.uint64), int(totals.sum()) + 1),
            quantised(value(np.zeros(len(words)), totals)),
            code(np.append(begin, len(word)).astype(np.uint64), len(word) + 1),
            code(relative, max(len(words), 1) << CONTEXT_BITS),
            quantised(value(count, totals[place] if len(place) else totals)),
        )

    def look_up(self, word: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each word and stored value in its context; unknown words have count 0 and NaN."""
        count, out = np.zeros(len(word), np.int64), np.full(len(word), np.nan)
        if not self.words.n:
            return count, out
        place = np.minimum(self.words.find(word), self.words.n - 1)
        known = np.flatnonzero(self.words.at(place) == word)
        place, context = place[known], context[known]
        upto = self.counts.at(place).astype(np.int64)
        before = np.where(place > 0, self.counts.at(np.maximum(place - 1, 0)).astype(np.int64), 0)
        count[known] = upto - before
        start, step, *_ = self.scales[0]
        value = start + step * self.codes[0][place]
        first, last = self.pointers.at(place).astype(np.int64), self.pointers.at(place + 1).astype(np.int64)
        want = place.astype(np.uint64) << np.uint64(CONTEXT_BITS) | context
        at = self.contexts.find(want, first, last)
        inside = np.minimum(at, self.contexts.n - 1)
        found = (at < last) & (self.contexts.at(inside) == want)
        start, step, *_ = self.scales[1]
        out[known] = np.where(found, start + step * self.codes[1][inside], value)
        return count, out
