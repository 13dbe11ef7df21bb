"""An FM-index over symbols: counts by backward search, places by sampled suffix positions.

All steps work on arrays, so that many patterns are searched at once.
"""

from __future__ import annotations

import numpy as np

#: Every so many text positions keep their suffix position.
SAMPLE = 8


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the length that is compared until all ranks differ."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, step = np.argsort(rank, kind="stable"), 1
    while n and rank[order[-1]] < n - 1:
        second = np.zeros(n, np.int64)
        second[: max(n - step, 0)] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        step *= 2
    return order


class WaveletRanks:
    """Ranks of any symbol below any place, from one bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for b in range(bits - 1, -1, -1):
            bit = (symbols >> b) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(int(len(symbols) - self.ones[-1][-1]))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        begin = np.zeros(len(symbol), np.int64)
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            one, ones, zeros = ((symbol >> b) & 1).astype(bool), self.ones[level], self.zeros[level]
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
            place = np.where(one, zeros + ones[place], place - ones[place])
        return place - begin

    def at(self, place: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(place), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            one = ones[place + 1] > ones[place]
            symbol = 2 * symbol + one
            place = np.where(one, zeros + ones[place], place - ones[place])
        return symbol


class FMIndex:
    """Index of a text of symbols from 1 up; 0 separates its parts and is in no pattern."""

    def __init__(self, text: np.ndarray, symbols: int):
        # the end of the text is a symbol of its own, below the separator
        text = np.append(np.asarray(text, np.int64) + 1, 0)
        order = suffix_order(text)
        self.ranks = WaveletRanks(text[order - 1], int(symbols + 1).bit_length())
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols + 2))))
        kept = order % SAMPLE == 0
        self.kept = np.concatenate(([0], np.cumsum(kept)))
        self.places, self.size = order[kept], len(text)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes that begin with each pattern, from its last symbol to its first; padded with 0."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        for j in range(patterns.shape[1] - 1, -1, -1):
            on = np.flatnonzero((j < lengths) & (low < high))
            if len(on):
                c = patterns[on, j] + 1
                low[on] = self.before[c] + self.ranks.rank(c, low[on])
                high[on] = self.before[c] + self.ranks.rank(c, high[on])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps back until a row whose position was kept."""
        rows, out, walked = rows.copy(), np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        on = np.arange(len(rows))
        while len(on):
            here = rows[on]
            there = self.kept[here + 1] > self.kept[here]
            done = on[there]
            out[done] = self.places[self.kept[rows[done]]] + walked[done]
            on = on[~there]
            c = self.ranks.at(rows[on])
            rows[on] = self.before[c] + self.ranks.rank(c, rows[on])
            walked[on] += 1
        return out
