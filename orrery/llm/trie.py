"""Double-array tries over sequences of word numbers, built and walked in numpy.

A state is a place in three arrays: the child of state ``s`` by word ``w`` is
place ``base[s] + w`` if ``check`` there names ``s``; ``accept`` holds the
number of the sequence that ends in a state, or -1.
"""

from __future__ import annotations

import numpy as np

PROBES, ROUNDS, SMALL = 64, 24, 8


class Trie:
    def __init__(self, rows: np.ndarray, accept: np.ndarray | None = None, seed: int = 7):
        """``rows``: distinct sequences of one length, a row each; ``accept``: their numbers, by default the row numbers."""
        rows = np.asarray(rows, np.int64)
        self.depth = rows.shape[1]
        order = np.lexsort(rows.T[::-1]) if len(rows) else np.empty(0, np.int64)
        rows, number = rows[order], order if accept is None else np.asarray(accept)[order]
        self._rng = np.random.default_rng(seed)
        words = int(rows.max()) + 1 if len(rows) else 1
        size = words + 2 * rows.size + 1024
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.accept = np.full(size, -1, np.int32)
        self.check[0] = -2  # the root is no child, and the last place stays free, so that clipped places never match
        slots = np.zeros(len(rows), np.int64)  # state of each row's prefix
        fresh = np.zeros(len(rows), bool)
        for depth in range(self.depth):
            before, label = slots, rows[:, depth]
            fresh = fresh | np.concatenate([[True], label[1:] != label[:-1]])[:len(rows)]
            first = np.flatnonzero(fresh)  # a row of each new state
            if depth == 0:
                self.base[0] = 1
                places = 1 + label[first]
                self.check[places] = 0
            else:
                places = self._place(before[first], label[first])
            slots = np.repeat(places, np.diff(np.append(first, len(rows))))
        self.accept[slots] = number

    def _place(self, parents: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Give each parent (its children are neighbours in the arguments) a base; returns the children's places."""
        starts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        counts = np.diff(np.append(starts, len(parents)))
        out = np.zeros(len(parents), np.int64)
        for at in np.argsort(-counts, kind="stable")[:int((counts > SMALL).sum())]:
            own = slice(starts[at], starts[at] + counts[at])
            out[own] = self._settle(parents[starts[at]:starts[at] + 1], labels[None, own])[0]
        for count in range(SMALL, 0, -1):
            at = starts[counts == count]
            if len(at):
                own = at[:, None] + np.arange(count)
                out[own] = self._settle(parents[at], labels[own])
        return out

    def _settle(self, parents: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Places for groups of equally many children: random shifts of all groups at once, until none collides."""
        places, left, rounds = np.zeros(labels.shape, np.int64), np.arange(len(parents)), 0
        span = labels[:, -1] - labels[:, 0]
        repeat = PROBES if len(parents) == 1 else 1
        while len(left):
            rounds += 1
            room = len(self.check) - 1
            if rounds > ROUNDS or int(span.max()) + 2 > room // 2:
                self._grow()
                rounds = 0
                continue
            tries = np.repeat(left, repeat)
            first = 1 + (self._rng.random(len(tries)) * (room - 1 - span[tries])).astype(np.int64)
            at = first[:, None] + labels[tries] - labels[tries, :1]
            free = (self.check[at] == -1).all(axis=1)
            if repeat > 1:
                free = free & (np.cumsum(free) == 1)
            tries, at = tries[free], at[free]
            self.check[at.ravel()] = np.repeat(-3 - tries, at.shape[1]).astype(np.int32)  # claims; the last one holds
            won = (self.check[at] == (-3 - tries)[:, None]).all(axis=1)
            lost = at[~won]
            mine = self.check[lost] == (-3 - tries[~won])[:, None]
            self.check[lost[mine]] = -1
            tries, at = tries[won], at[won]
            places[tries] = at
            self.check[at] = parents[tries][:, None]
            self.base[parents[tries]] = at[:, 0] - labels[tries, 0]
            left = left[~np.isin(left, tries)] if len(tries) else left
        return places

    def _grow(self) -> None:
        more = len(self.check)
        self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
        self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])
        self.accept = np.concatenate([self.accept, np.full(more, -1, np.int32)])

    def walk(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, numbers): where in ``codes`` (-1: a break) a sequence begins, and which; all positions advance at once."""
        codes = np.concatenate([codes, np.full(self.depth, -1, codes.dtype)])
        at = np.flatnonzero(codes >= 0)
        state = np.zeros(len(at), np.int64)
        for depth in range(self.depth):
            word = codes[at + depth]
            go = word >= 0
            at, state = at[go], state[go]
            child = np.clip(self.base[state] + word[go].astype(np.int64), 0, len(self.check) - 1)
            go = self.check[child] == state
            at, state = at[go], child[go]
        number = self.accept[state]
        return at[number >= 0], number[number >= 0]
