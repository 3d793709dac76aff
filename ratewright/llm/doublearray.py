"""A double-array trie whose states numpy advances for many positions at once.

Symbols are bytes. The child of a state by a byte stands at ``base[state] + byte`` and is
that state's child exactly if ``check`` there names the state. Building places the child
sets of all states: dense sets get 256 slots of their own, sparse ones are tried at random
bases in rounds until no two of them share a slot, the largest first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_DENSE = 24  # children from which on a state gets slots of its own


@dataclass
class DoubleArray:
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray  # 1 + number of the key that ends at the state, or 0

    ROOT = 0

    def advance(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which, state): the states that have a child by their symbol, and that child."""
        slots = self.base[states] + symbols
        which = np.flatnonzero(self.check[slots] == states)
        return which, slots[which]


def _place(counts: np.ndarray, first: np.ndarray, symbols: np.ndarray, nodes: int) -> tuple[np.ndarray, int]:
    """A base for each state with children such that no two children share a slot; slot 0 is the root's."""
    dense = np.flatnonzero(counts >= _DENSE)
    base = np.full(len(counts), 1, dtype=np.int64)
    base[dense] = 1 + 256 * np.arange(len(dense))
    floor = 1 + 256 * len(dense)
    room = max(1024, 4 * nodes)
    used = np.zeros(floor + room + 256, dtype=bool)
    used[:floor] = True
    random = np.random.default_rng(1)
    sparse = np.flatnonzero((counts > 0) & (counts < _DENSE))
    for low, high in ((12, _DENSE), (6, 12), (3, 6), (2, 3), (1, 2)):
        left = sparse[(counts[sparse] >= low) & (counts[sparse] < high)]
        while len(left):
            tried = floor + random.integers(0, room, len(left))
            n = counts[left]
            owner = np.repeat(np.arange(len(left)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[left][owner]
            slots = tried[owner] + symbols[at]
            _, where, times = np.unique(slots, return_inverse=True, return_counts=True)
            bad = used[slots] | (times[where] > 1)
            fails = np.zeros(len(left), dtype=bool)
            fails[owner[bad]] = True
            good = ~fails[owner]
            used[slots[good]] = True
            base[left[~fails]] = tried[~fails]
            left = left[fails]
    return base, len(used)


def build(keys: np.ndarray, lengths: np.ndarray) -> DoubleArray:
    """A trie of distinct byte rows ``keys``, of which the first ``lengths[i]`` bytes count."""
    n, width = keys.shape
    node = np.zeros(n, dtype=np.int64)  # of each key at the present depth; 0 is the root
    parents, symbols, ends = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], np.zeros(n, dtype=np.int64)
    total = 1
    for depth in range(width):
        on = np.flatnonzero(lengths > depth)
        pairs, which = np.unique(node[on] * 256 + keys[on, depth], return_inverse=True)
        parents.append(pairs >> 8)
        symbols.append(pairs & 255)
        node[on] = total + which
        total += len(pairs)
        done = on[lengths[on] == depth + 1]
        ends[done] = node[done]
    parent, symbol = np.concatenate(parents), np.concatenate(symbols)
    order = 1 + np.argsort(parent[1:], kind="stable")  # children by parent
    counts = np.bincount(parent[1:], minlength=total)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    base, size = _place(counts, first, symbol[order], total)
    slot = np.zeros(total, dtype=np.int64)
    slot[1:] = base[parent[1:]] + symbol[1:]
    array = DoubleArray(np.ones(size + 256, np.int32), np.full(size + 256, -1, np.int32), np.zeros(size + 256, np.int32))
    array.base[slot] = base
    array.check[slot[1:]] = slot[parent[1:]]
    array.accept[slot[ends]] = np.arange(1, n + 1)
    return array
