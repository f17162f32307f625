"""Merges of neighbouring symbols, for training and encoding.

Symbols are small whole numbers, bytes first.  ``merge_symbols`` works on a linked
list with a heap of the mergeable pairs, so a word of n symbols takes n log n steps.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from heapq import heapify, heappop, heappush

import numpy as np

Pair = tuple[int, int]


def merge_symbols(symbols: list[int], options: dict[Pair, list[tuple[int, int]]], in_turn: bool = False,
                  weight: int = 0, since: int = 0, changes: dict | None = None) -> list[int]:
    """The symbols after all merges: the lowest order first, from the left within an order.

    ``options`` gives the orders and joined symbols of a pair, ascending.  With
    ``in_turn`` every order has its turn once, and a pair that comes up after its turn
    waits for its next order; otherwise a pair's first order always counts.  From order
    ``since`` on, ``changes[order, left, right]`` sums how the number of pairs changes
    by a word that occurs ``weight`` times.
    """
    n = len(symbols)
    value, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap, at = [], 0
    for i in range(n - 1):
        if found := options.get((value[i], value[i + 1])):
            heap.append((found[0][0], i, value[i], value[i + 1], found[0][1]))
    if not heap:
        return value
    heapify(heap)

    def offer(i: int, j: int, turn: int) -> None:
        for order, joined in options.get((value[i], value[j]), ()):
            if not in_turn or order > turn:
                heappush(heap, (order, i, value[i], value[j], joined))
                return

    def count(order: int, left: int, right: int, by: int) -> None:
        key = order, left, right
        changes[key] = changes.get(key, 0) + by

    while heap:
        order, i, left, right, joined = heappop(heap)
        j = after[i]
        if value[i] != left or j >= n or value[j] != right:
            continue
        b, a = before[i], after[j]
        if changes is not None and order >= since:
            count(order, left, right, -weight)
            if b >= 0:
                count(order, value[b], left, -weight)
                count(order, value[b], joined, weight)
            if a < n:
                count(order, right, value[a], -weight)
                count(order, joined, value[a], weight)
        value[i], value[j], after[i] = joined, -1, a
        if a < n:
            before[a] = i
            offer(i, a, order)
        if b >= 0:
            offer(b, i, order)
    while at < n:
        if value[at] < 0:
            raise AssertionError("a joined symbol is in the list")
        heap.append(value[at])
        at = after[at]
    return heap


def merge_words(symbols: np.ndarray, lengths: np.ndarray, steps: list[tuple[Pair, int]],
                weights: np.ndarray | None = None, since: int = 0) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Many words after all steps, each in its turn and from the left, like ``merge_symbols`` with ``in_turn``.

    ``symbols`` has the words one after the other, ``lengths`` their sizes.  With
    ``weights``, the times of each word, the third result is ``step, left, right, d``:
    how the number of pairs changes from step ``since`` on, in rows that may repeat.
    """
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    seen = np.zeros(max([int(symbols.max(initial=0)), *(max(*pair, joined) for pair, joined in steps)]) + 1, bool)
    seen[symbols] = True
    changes: list[tuple[np.ndarray, ...]] = []
    for step, ((left, right), joined) in enumerate(steps):
        if not (seen[left] and seen[right]):
            continue
        at = np.flatnonzero(symbols[:-1] == left)
        at = at[(symbols[at + 1] == right) & (owner[at] == owner[at + 1])]
        if left == right and len(at):
            # In a run of the symbol every second pair is joined, from the left.
            first = np.r_[True, np.diff(at) > 1]
            run = np.flatnonzero(first)
            at = at[(np.arange(len(at)) - run[np.cumsum(first) - 1]) % 2 == 0]
        if not len(at):
            continue
        kept = np.ones(len(symbols), bool)
        kept[at + 1] = False
        if weights is not None and step >= since:
            _count(changes, step, symbols, owner, np.unique(np.concatenate([at - 1, at, at + 1])), weights, -1)
        symbols[at] = joined
        symbols, owner, seen[joined] = symbols[kept], owner[kept], True
        if weights is not None and step >= since:
            now = at - np.arange(len(at))
            _count(changes, step, symbols, owner, np.unique(np.concatenate([now - 1, now])), weights, 1)
    sums = [np.concatenate(c) if c else np.empty(0, np.int64) for c in zip(*changes)] or [np.empty(0, np.int64)] * 4
    return symbols, np.bincount(owner, minlength=len(lengths)), sums


def _count(changes: list, step: int, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray, weights: np.ndarray, sign: int) -> None:
    """Add the pairs that begin at these places and lie within a word, each pair once."""
    at = at[(at >= 0) & (at < len(symbols) - 1)]
    at = at[owner[at] == owner[at + 1]]
    pairs, place = np.unique(symbols[at].astype(np.int64) << 32 | symbols[at + 1], return_inverse=True)
    sums = np.zeros(len(pairs), np.int64)
    np.add.at(sums, place, weights[owner[at]])
    changes.append((np.full(len(pairs), step), pairs >> 32, pairs & (1 << 32) - 1, sign * sums))


class Ranking:
    """Pairs by count, then by the bytes of both symbols, highest first."""

    def __init__(self, counts: dict[Pair, int], names: list[bytes]):
        self.counts, self.names, self._keys = dict(counts), names, {}
        self._heap = [(*self.key(p, n), p) for p, n in counts.items() if n > 0]
        heapify(self._heap)

    def _late(self, symbol: int) -> tuple[int, ...]:
        """Sorts the other way round than the symbol's bytes; a longer string comes before its beginnings."""
        if symbol not in self._keys:
            self._keys[symbol] = (*(255 - b for b in self.names[symbol]), 256)
        return self._keys[symbol]

    def key(self, pair: Pair, n: int) -> tuple:
        return -n, self._late(pair[0]), self._late(pair[1])

    def add(self, pair: Pair, by: int) -> None:
        n = self.counts[pair] = self.counts.get(pair, 0) + by
        if n > 0:
            heappush(self._heap, (*self.key(pair, n), pair))

    def best(self) -> Pair | None:
        while self._heap:
            pair = self._heap[0][3]
            if self.counts[pair] == -self._heap[0][0]:
                return pair
            heappop(self._heap)
        return None


class Forecast:
    """Pair counts of a sample of words while merges are tried on it and taken back."""

    def __init__(self, words: list[tuple[list[int], int]]):
        self.words, self.n = [list(s) for s, _ in words], [n for _, n in words]
        self.counts, self.places, self._log = Counter(), defaultdict(set), []
        for i, (s, n) in enumerate(words):
            for p in zip(s, s[1:]):
                self.counts[p] += n
                self.places[p].add(i)

    def merge(self, pair: Pair, joined: int) -> dict[Pair, int]:
        """Merge a pair in all words; how the pairs' counts change."""
        changes: Counter[Pair] = Counter()
        before = []
        for i in list(self.places[pair]):
            old, n, new, k = self.words[i], self.n[i], [], 0
            while k < len(old):
                hit = old[k] == pair[0] and k + 1 < len(old) and old[k + 1] == pair[1]
                new.append(joined if hit else old[k])
                k += 2 if hit else 1
            if len(new) == len(old):
                continue
            before.append((i, old))
            self.words[i] = new
            for p in zip(old, old[1:]):
                changes[p] -= n
            for p in zip(new, new[1:]):
                changes[p] += n
                self.places[p].add(i)
        self.counts.update(changes)
        self._log.append((before, changes))
        return {p: d for p, d in changes.items() if d}

    def keep(self, merges: int) -> None:
        """Keep the first ``merges`` since the last call and take the others back."""
        for before, changes in reversed(self._log[merges:]):
            self.counts.subtract(changes)
            for i, old in before:
                self.words[i] = old
                for p in zip(old, old[1:]):
                    self.places[p].add(i)
        self._log = []
