"""Double-array tries over sequences of symbols, read at many places of a text at once.

Node s has its child by symbol c at slot base[s] + c, and that slot is its child if check there
says s.  So one step for all places is two gathers and a comparison.  Slot 0 is the root, symbols
count from 1; 0 stands for what no sequence has, and leads nowhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Places tried for a node's children at a time: the first free slots, then some anywhere, and how
#: often, before the children go behind all others.
TRIED, ROUNDS = 256, 12


@dataclass
class Trie:
    base: np.ndarray
    check: np.ndarray

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The slots that lead on from ``state`` by ``symbol``; -1 where there is none."""
        to = self.base[state] + symbol
        good = (to > 0) & (to < len(self.check))
        good &= self.check[np.where(good, to, 0)] == state
        return np.where(good, to, -1)


class _Slots:
    """Slots taken so far; the arrays grow with what is put in."""

    def __init__(self, expected: int):
        self.used = np.zeros(max(1024, 2 * expected), bool)
        self.used[0] = True
        self.first, self.last = 1, 0  # no slot below first is free; last is the greatest one taken
        self.random = np.random.default_rng(7)

    def place(self, symbols: np.ndarray) -> int:
        """A base at which all symbols (ascending) fall on free slots, which are then taken."""
        if self.last + int(symbols[-1]) + 2 * TRIED >= len(self.used):
            more = np.zeros(2 * len(self.used) + int(symbols[-1]), bool)
            more[: len(self.used)] = self.used
            self.used = more
        low = 1 - int(symbols[0])  # of bases; the one behind all slots taken is sure to do
        base = self.last + low
        span = symbols - symbols[0]
        for i in range(ROUNDS):
            if len(symbols) == 1:
                tried = np.array([self.first])
            elif i:
                tried = np.sort(self.random.integers(1, self.last + 2, TRIED))
            else:
                tried = self.first + np.flatnonzero(~self.used[self.first : self.first + TRIED])
            good = np.flatnonzero(~self.used[tried[:, None] + span].any(axis=1))
            if len(good):
                base = int(tried[good[0]]) - int(symbols[0])
                break
        taken = base + symbols
        self.used[taken] = True
        self.last = max(self.last, int(taken[-1]))
        while self.used[self.first]:
            self.first += int(np.argmin(self.used[self.first : self.first + TRIED])) or TRIED
        return base


def build(sequences: np.ndarray) -> tuple[Trie, np.ndarray]:
    """The trie of sequences (rows, symbols from 1, 0 behind their end), and their slots.

    Children of many-symbol nodes are placed first, while there is room; single ones fill gaps.
    """
    rows, depth = sequences.shape
    node = np.zeros(rows, np.int64)  # numbers of nodes, 0 the root
    links, count = [], 1
    for level in range(depth):
        symbol = sequences[:, level]
        on = np.flatnonzero(symbol > 0)
        if not len(on):
            break
        width = int(symbol.max()) + 1
        key, inverse = np.unique(node[on] * width + symbol[on], return_inverse=True)
        links.append(np.stack([key // width, key % width, count + np.arange(len(key))], axis=1))
        node = node.copy()
        node[on] = count + inverse
        count += len(key)
    links = np.concatenate([np.zeros((0, 3), np.int64), *links])
    links = links[np.lexsort((links[:, 1], links[:, 0]))]
    parents, begin, size = np.unique(links[:, 0], return_index=True, return_counts=True)
    slots, slot, base_of = _Slots(count), np.zeros(count, np.int64), np.zeros(count, np.int64)
    for i in np.argsort(-size, kind="stable"):
        symbols = links[begin[i] : begin[i] + size[i], 1]
        base_of[parents[i]] = base = slots.place(symbols)
        slot[links[begin[i] : begin[i] + size[i], 2]] = base + symbols
    base = np.zeros(slots.last + 1, np.int32)
    check = np.full(slots.last + 1, -1, np.int32)
    base[slot] = base_of
    check[slot[links[:, 2]]] = slot[links[:, 0]]
    return Trie(base, check), slot[node]
