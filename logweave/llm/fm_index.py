"""An FM-index over integer symbols: backward search and location by sampled positions.

Symbol 0 separates segments. Each separator is its own smallest symbol, in
text order, so no match and no suffix comparison crosses one, and the
number of sorting rounds follows the longest segment, not the text.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; only suffixes still tied are sorted again."""
    n = len(text)
    seps = np.cumsum(text == 0)
    rank = np.where(text == 0, seps - 1, text.astype(np.int64) + seps[-1])
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        s = rank[order]
        new = np.empty(n, bool)
        new[0] = True
        np.not_equal(s[1:], s[:-1], out=new[1:])
        first = np.flatnonzero(new)
        rank[order] = np.repeat(first, np.diff(np.append(first, n)))  # a tie's rank: its first place
        tied = ~(new & np.append(new[1:], True))
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        rows = order[at]
        second = rank[np.minimum(rows + step, n - 1)]
        order[at] = rows[np.lexsort((second, rank[rows]))]
        # split ties by the second half: a new rank must see (first, second)
        rows = order[at]
        pair = rank[rows], rank[np.minimum(rows + step, n - 1)]
        fresh = np.append(True, (pair[0][1:] != pair[0][:-1]) | (pair[1][1:] != pair[1][:-1]))
        starts = np.flatnonzero(fresh)
        rank[rows] = np.repeat(at[starts], np.diff(np.append(starts, len(at))))
        step *= 2


class WaveletTree:
    """Ranks of symbols in a sequence, by levels of bits (a wavelet matrix)."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        seq = seq.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (seq >> level & 1).astype(bool)
            padded = np.zeros((len(bit) // 64 + 1) * 64, bool)
            padded[:len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.bits.append(words)
            self.counts.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64))))
            self.zeros.append(len(bit) - int(bit.sum()))
            seq = np.concatenate((seq[~bit], seq[bit]))
        self.start = self._walk(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            words, low = self.bits[k][at >> 6], (at & 63).astype(np.uint64)
            ones = self.counts[k][at >> 6] + np.bitwise_count(words & ((np.uint64(1) << low) - np.uint64(1)))
            at = np.where(symbol >> level & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each ``symbol`` is among the first ``at`` places."""
        return self._walk(symbol, at) - self.start[symbol]


class FMIndex:
    def __init__(self, text: np.ndarray, n_symbols: int, sample: int = 8):
        """``text`` must end with the separator 0."""
        order = suffix_array(text)
        self.bwt = text[order - 1].astype(np.int64)  # what precedes the first place is the last separator
        self.tree = WaveletTree(self.bwt, n_symbols)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_symbols))))[:-1]
        kept = (order % sample == 0) | (self.bwt == 0)  # no walk crosses a separator
        self.sampled = np.where(kept, order, -1)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of all patterns at once. Rows of ``patterns`` are right-aligned; symbols from 1 on."""
        n = len(patterns)
        low, high = np.zeros(n, np.int64), np.full(n, len(self.bwt), np.int64)
        width = patterns.shape[1]
        live = np.arange(n)
        for k in range(width):
            live = live[(lengths[live] > k) & (high[live] > low[live])]
            if not len(live):
                break
            symbol = patterns[live, width - 1 - k]
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step back through the text until a sampled row."""
        out, row, steps = np.full(len(rows), -1, np.int64), rows.copy(), 0
        left = np.arange(len(rows))
        while len(left):
            at = self.sampled[row[left]]
            out[left[at >= 0]] = at[at >= 0] + steps
            left = left[at < 0]
            symbol = self.bwt[row[left]]
            row[left] = self.before[symbol] + self.tree.rank(symbol, row[left])
            steps += 1
        return out
