"""An FM-index over words: suffix order, a wavelet matrix over the transform, and lengths of common beginnings."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; every run of words must end with a symbol of its own."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        later = np.zeros(n, np.int64)
        later[: max(0, n - width)] = rank[width:] + 1 if width < n else 0
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        fresh = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if not n or fresh[-1] == n - 1:
            return order
        width *= 2


class WaveletMatrix:
    """Symbols as bit rows of 64-bit words with counts, so that occurrences before a place take one look per bit."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        now = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (now >> level & 1).astype(np.uint8)
            packed = np.packbits(np.pad(bit, (0, -len(bit) % 64 + 64)), bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]))
            self.zeros.append(int(len(bit) - bit.sum()))
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def walk(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the prefix ending at ``place`` ends among the symbols of this kind; monotone in ``place``."""
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            block, rest = place >> 6, (place & 63).astype(np.uint64)
            ones = self.counts[i][block] + np.bitwise_count(self.bits[i][block] & ((np.uint64(1) << rest) - np.uint64(1)))
            place = np.where(symbol >> level & 1, self.zeros[i] + ones, place - ones)
        return place


class FmIndex:
    """Runs of words, each an array of 64-bit hashes, searchable backwards."""

    def __init__(self, runs: list[np.ndarray], depth: int):
        self.lengths = np.array([len(r) for r in runs])
        flat = np.concatenate(runs)
        self.alphabet, word = np.unique(flat, return_inverse=True)
        self.ends = np.cumsum(self.lengths + 1) - 1  # where each run's own end symbol stands
        n = int(self.ends[-1]) + 1
        is_end = np.zeros(n, bool)
        is_end[self.ends] = True
        text = np.zeros(n, np.int64)
        text[~is_end] = word + 1
        unlike = text + len(runs)
        unlike[is_end] = np.arange(len(runs))
        self.order = suffix_order(unlike)
        self.text, self.depth = text, depth
        self.run_of = np.cumsum(is_end) - is_end
        sigma = len(self.alphabet) + 1
        self.wavelet = WaveletMatrix(text[self.order - 1], sigma)
        every = np.arange(sigma)
        self.bases = self.wavelet.walk(every, np.zeros(sigma, np.int64))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.first, self.last = self.classes()

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the order, the stretch around it whose suffixes begin with the same ``depth`` words."""
        n = len(self.text)
        same = np.zeros(n, bool)
        left, right, at = self.order[:-1], self.order[1:], np.arange(1, n)
        for d in range(self.depth):
            inside = (left + d < n) & (right + d < n)
            at, left, right = at[inside], left[inside], right[inside]
            a, b = self.text[left + d], self.text[right + d]
            equal = (a == b) & (a != 0)
            at, left, right = at[equal], left[equal], right[equal]
        same[at] = True
        starts = np.flatnonzero(~same)
        number = np.cumsum(~same) - 1
        return starts[number], np.append(starts[1:], n)[number]

    def extend(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: the stretch of ``word`` followed by what the stretch [low, high) begins with."""
        base, before = self.bases[word], self.before[word]
        return before + self.wavelet.walk(word, low) - base, before + self.wavelet.walk(word, high) - base

    def matches(self, runs: list[np.ndarray], weights: np.ndarray) -> list[np.ndarray]:
        """For each start of ``depth`` words in each run, how often those words occur in the index, by weight.

        All runs are read in step from their ends. The matched length grows by a word a step and is cut back to
        ``depth`` by moving to the stretch of equal beginnings; a word that breaks the match starts it anew.
        """
        total = np.concatenate([[0], np.cumsum(weights[self.run_of[self.order]] * (self.text[self.order] != 0))])
        lengths = np.array([len(r) for r in runs])
        flat = np.concatenate(runs)
        place = np.minimum(np.searchsorted(self.alphabet, flat), len(self.alphabet) - 1)
        word = np.where(self.alphabet[place] == flat, place + 1, 0)
        ends = np.cumsum(lengths)
        low, high = np.zeros(len(runs), np.int64), np.full(len(runs), len(self.text), np.int64)
        length = np.zeros(len(runs), np.int64)
        found = np.zeros(len(flat), np.int64)
        by_length = np.argsort(-lengths, kind="stable")
        ordered = lengths[by_length]
        for step in range(int(lengths.max(initial=0))):
            live = by_length[: np.searchsorted(-ordered, -step, "left")]
            at = ends[live] - 1 - step
            w = word[at]
            lo, hi = self.extend(w, low[live], high[live])
            broken = (hi <= lo) | (w == 0)
            if broken.any():
                # Shorter matches that end before this word can't reach ``depth`` with it; begin again from the word.
                zero = np.zeros(int(broken.sum()), np.int64)
                alone = self.extend(w[broken], zero, zero + len(self.text))
                lo[broken], hi[broken] = alone
            grown = np.where(broken, (w != 0) & (hi > lo), length[live] + 1)
            none = grown == 0
            lo, hi = np.where(none, 0, lo), np.where(none, len(self.text), hi)
            long = grown >= self.depth
            some = lo[long]
            found[at[long]] = total[self.last[some]] - total[self.first[some]]
            lo[long], hi[long] = self.first[some], self.last[some]
            low[live], high[live], length[live] = lo, hi, np.minimum(grown, self.depth)
        stops = ends - self.depth + 1
        return [found[e - n : max(e - n, s)] for e, n, s in zip(ends, lengths, stops, strict=True)]
