"""Cutting-stock column generation over a histogram of lengths.

A *pattern* says how many items of each length one sequence holds. The
linear program over patterns is solved by the simplex method; columns are
priced by a knapsack dynamic program over all fills. A sequence costs the
tokens it takes with its padding (its fill if that is a power of two, else
the capacity), and one more, so that fewer sequences win among equals.

The histogram has at most ``capacity`` lengths, so the work here depends on
the capacity alone, never on how many items there are.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

#: The program ends when its cost is within this share of the tokens' own, or no column improves it.
GAP = 0.0002
#: Pivots that one program may take for each length (any basis packs rightly, a better one cuts less),
#: and columns taken from one dynamic program.
PIVOTS_PER_LENGTH = 1
COLUMNS = 40
#: Pivots after which the basis is inverted anew.
REFRESH = 400


@dataclass
class Pattern:
    """``count[k]`` items of ``length[k]`` (distinct, descending), in ``times`` sequences."""
    length: np.ndarray
    count: np.ndarray
    times: int = 0

    @property
    def fill(self) -> int:
        return int(self.length @ self.count)


def padded(fill: int, capacity: int) -> int:
    """Tokens that a sequence of ``fill`` tokens takes."""
    return fill if fill & (fill - 1) == 0 else capacity


def _pattern(lengths: list[int]) -> Pattern:
    found, count = np.unique(np.array(lengths, np.int64), return_counts=True)
    return Pattern(found[::-1], count[::-1])


def knapsack(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of items that fill exactly ``0..capacity``, and the last item of each fill.

    ``value[l]`` is the value of an item of length ``l`` (-inf: there is none).
    """
    best, last = np.full(capacity + 1, -np.inf), np.zeros(capacity + 1, np.int64)
    best[0] = 0
    backwards = np.full(capacity + 1, -np.inf)  # backwards[capacity - c] = best[c]
    backwards[capacity] = 0
    for c in range(1, capacity + 1):
        options = value[1:c + 1] + backwards[capacity - c + 1:]
        k = int(options.argmax())
        best[c], last[c] = options[k], k + 1
        backwards[capacity - c] = options[k]
    return best, last


def _items(last: np.ndarray, fill: int) -> list[int]:
    out = []
    while fill:
        out.append(int(last[fill]))
        fill -= out[-1]
    return out


def greedy_pattern(left: np.ndarray, capacity: int, whole: bool) -> list[int]:
    """A pattern around the longest length that is left: the longest that fits, again and again.

    ``left[l]`` items have length ``l``. With ``whole`` a pattern holds no
    more of a length than there are, and one or two items that fill it
    exactly come first.
    """
    left = left.copy()
    items, spare = [], capacity
    while spare > 0:
        there = left[:spare + 1] > 0
        if whole and items and there[spare]:
            one = [spare]
        elif whole and items and (pair := _pair(left, spare)):
            one = list(pair)
        else:
            at = np.flatnonzero(there)
            if not len(at):
                break
            one = [int(at[-1])]
        for length in one:
            items.append(length)
            spare -= length
            if whole:
                left[length] -= 1
    return items


def _pair(left: np.ndarray, spare: int) -> tuple[int, int] | None:
    there = left[:spare + 1] > 0
    both = np.flatnonzero(there & there[::-1])
    both = both[2 * both >= spare]
    if len(both) and 2 * both[0] == spare and left[both[0]] < 2:
        both = both[1:]
    return (int(both[0]), spare - int(both[0])) if len(both) else None


class _Program:
    """The linear program's basis: one column for each length, and the inverse of their matrix."""

    def __init__(self, need: np.ndarray, capacity: int):
        self.capacity = capacity
        self.lengths = np.flatnonzero(need)
        self.row = np.full(capacity + 1, -1)
        self.row[self.lengths] = np.arange(len(self.lengths))
        self.need = need[self.lengths].astype(float)
        self.columns, left, alive = [], need.astype(float), (need > 0).astype(float)
        for _ in self.lengths:  # each column uses one length up, so their matrix is triangular
            p = _pattern(greedy_pattern(alive, capacity, whole=False))
            most = left[p.length] / p.count
            k = int(most.argmin())
            left[p.length] -= max(most[k], 0) * p.count
            left[p.length[k]] = alive[p.length[k]] = 0
            self.columns.append(p)
        self.refresh()

    def cost(self, p: Pattern) -> float:
        return padded(p.fill, self.capacity) + 1.0

    def refresh(self) -> None:
        n = len(self.lengths)
        matrix = np.zeros((n, n))
        for j, p in enumerate(self.columns):
            matrix[self.row[p.length], j] = p.count
        self.inverse = np.linalg.inv(matrix)
        self.costs = np.array([self.cost(p) for p in self.columns])
        self.x = np.maximum(self.inverse @ self.need, 0)
        self.price = self.costs @ self.inverse

    def gain(self, p: Pattern) -> float:
        return float(self.price[self.row[p.length]] @ p.count) - self.cost(p)

    def enter(self, p: Pattern) -> None:
        """Bring a column with a gain into the basis for the one that limits it."""
        gain = self.gain(p)
        change = self.inverse[:, self.row[p.length]] @ p.count
        up = np.flatnonzero(change > 1e-9)
        ratio = self.x[up] / change[up]
        out = up[int(ratio.argmin())]
        step = max(float(ratio.min()), 0.0)
        self.x = np.maximum(self.x - step * change, 0)
        self.x[out] = step
        row = self.inverse[out] / change[out]
        self.price -= gain * row
        change[out] = 0
        other = np.flatnonzero(np.abs(change) > 1e-12)
        used = np.flatnonzero(row)
        self.inverse[np.ix_(other, used)] -= np.outer(change[other], row[used])
        self.inverse[out] = row
        self.columns[out], self.costs[out] = p, self.cost(p)

    def priced(self) -> list[Pattern]:
        """Columns with a gain at the present prices, the best of each first item."""
        value = np.full(self.capacity + 1, -np.inf)
        value[self.lengths] = self.price
        best, last = knapsack(value, self.capacity)
        fills = 1 << np.arange(self.capacity.bit_length())
        fills = fills[fills < self.capacity]
        ends = [(best[f] - f - 1, int(f), 0) for f in fills]
        top = np.maximum.accumulate(best)  # best fill up to each spare length
        at = np.maximum.accumulate(np.where(best == top, np.arange(self.capacity + 1), 0))
        spare = self.capacity - self.lengths
        ends += list(zip(self.price + top[spare] - self.capacity - 1, at[spare].tolist(), self.lengths.tolist()))
        found = {}
        for gain, fill, first in heapq.nlargest(COLUMNS, ends):
            if gain > 1e-6:
                items = _items(last, int(fill)) + ([first] if first else [])
                found[tuple(sorted(items))] = items
        return [_pattern(i) for i in found.values()]

    def solve(self) -> None:
        tokens = float(self.need @ self.lengths)
        enough = tokens * (1 + 1 / self.capacity) * (1 + GAP)
        pivots, limit = 0, PIVOTS_PER_LENGTH * len(self.lengths)
        while pivots < limit and self.costs @ self.x > enough:
            entered = False
            for p in self.priced():
                if self.gain(p) > 1e-6:
                    self.enter(p)
                    pivots, entered = pivots + 1, True
                    if pivots % REFRESH == 0:
                        self.refresh()
            if not entered:
                break
        self.refresh()


def solve(need: np.ndarray, capacity: int) -> tuple[list[Pattern], np.ndarray]:
    """Patterns with whole ``times``, and how many items of each length are left to be cut.

    ``need[l]`` items have length ``l`` (``l < capacity``). The left items
    fill every gap of the patterns, or are more: then they are ends of their own.
    """
    left = need.astype(np.int64).copy()
    patterns: list[Pattern] = []
    if left.any():
        program = _Program(left, capacity)
        program.solve()
        share = sorted(zip(program.x, program.columns), key=lambda t: t[0] - np.floor(t[0] + 1e-9), reverse=True)
        for x, p in share:
            p.times = max(0, min(int(x + 1e-9), int((left[p.length] // p.count).min())))
            left[p.length] -= p.times * p.count
        for _, p in share:  # round up, the largest shares first, where the items are there
            if (left[p.length] >= p.count).all():
                p.times += 1
                left[p.length] -= p.count
        patterns = [p for _, p in share if p.times]
        patterns += _exact(left, capacity)
    return _gaps_filled(patterns, left, capacity), left


def _exact(left: np.ndarray, capacity: int) -> list[Pattern]:
    """Patterns without padding from the items that are left, which they reduce."""
    found, todo = [], left.copy()
    while todo.any():
        p = _pattern(greedy_pattern(todo, capacity, whole=True))
        if padded(p.fill, capacity) > p.fill:
            todo[p.length[0]] = 0
            continue
        p.times = int((todo[p.length] // p.count).min())
        todo[p.length] -= p.times * p.count
        left[p.length] -= p.times * p.count
        found.append(p)
    return found


def gap_of(p: Pattern, capacity: int) -> int:
    """Padding of one sequence of a pattern."""
    return padded(p.fill, capacity) - p.fill


def _gaps_filled(patterns: list[Pattern], left: np.ndarray, capacity: int) -> list[Pattern]:
    """Give up sequences, those with the widest gaps first, until the items left can fill all gaps."""
    short = sum(p.times * gap_of(p, capacity) for p in patterns) - int(left @ np.arange(len(left)))
    for p in sorted(patterns, key=lambda p: gap_of(p, capacity), reverse=True):
        if short <= 0:
            break
        if gap := gap_of(p, capacity):
            n = min(p.times, -(-short // (gap + p.fill)))
            p.times -= n
            left[p.length] += n * p.count
            short -= n * (gap + p.fill)
    return [p for p in patterns if p.times]
