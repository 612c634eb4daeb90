"""Longest common extensions from a sorted difference-cover sample, in numpy.

A difference cover of modulus v is a set of residues such that every difference
modulo v is one between two of them. Of a sequence only the suffixes that begin at
covered residues are sorted. For any two places there is a shift below v that
takes both to sampled places; so the common prefix of two suffixes is found by
comparing the few words before that shift, then by a range minimum over the common
prefixes of neighbours in the sorted sample (a sparse table).

A sequence of n words needs about 25 bytes a word: 6 of 31 suffixes are sampled,
and each is in log2 of their number rows of the sparse table.
"""

from __future__ import annotations

import numpy as np

#: A modulus and its residues; every difference but 0 occurs exactly once.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)


def shifts(modulus: int, cover: tuple[int, ...]) -> np.ndarray:
    """[i mod v, (j - i) mod v] -> the least shift that takes i and j to sampled places."""
    held = np.zeros(modulus, dtype=bool)
    held[list(cover)] = True
    i, d, k = np.ogrid[:modulus, :modulus, :modulus]
    both = held[(i + k) % modulus] & held[(i + d + k) % modulus]
    if not both.any(axis=2).all():
        raise ValueError("not a difference cover")
    return both.argmax(axis=2)


def ranked(key: np.ndarray) -> np.ndarray:
    """Place of each key's first equal in the sorted order; equal keys share it."""
    at = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.append(True, key[at][1:] != key[at][:-1]))
    out = np.empty(len(key), dtype=np.int64)
    out[at] = np.repeat(first, np.diff(np.append(first, len(key))))
    return out


def refined(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Ranks by (rank, key): the ``tied`` ones, whose keys are given, are sorted again inside their ties."""
    at = np.lexsort((key, rank[tied]))
    r, k = rank[tied][at], key[at]
    new_rank = np.append(True, r[1:] != r[:-1])
    new = new_rank | np.append(True, k[1:] != k[:-1])
    here = np.arange(len(at))
    first = np.maximum.accumulate(np.where(new, here, 0))
    group = np.maximum.accumulate(np.where(new_rank, here, 0))
    out = rank.copy()
    out[tied[at]] = r + first - group
    return out


def ties(rank: np.ndarray) -> np.ndarray:
    """Places whose rank is not theirs alone."""
    return np.flatnonzero(np.bincount(rank, minlength=1)[rank] > 1)


class Extensions:
    """Common prefixes of suffixes of ``x``, an array of codes from 1; what is beyond the end is equal to nothing."""

    def __init__(self, x: np.ndarray, modulus: int = MODULUS, cover: tuple[int, ...] = COVER):
        n = len(x)
        self.n, self.modulus, self.shift = n, modulus, shifts(modulus, cover)
        self.x = np.concatenate([x.astype(np.int64), np.zeros(modulus + 1, dtype=np.int64)])
        wide = np.int64(self.x.max() + 1)
        if wide >= 1 << 31:
            raise ValueError("codes must be below 2**31")
        starts = np.sort(np.concatenate([np.arange(c, n, modulus) for c in cover]))
        self.held = np.full(n + 1, -1, dtype=np.int64)
        self.held[starts] = np.arange(len(starts))
        # ranks by the first v words: two words a round, tied ones only
        rank = ranked(self.x[starts] * wide + self.x[starts + 1])
        for k in range(2, modulus, 2):
            tied = ties(rank)
            if not len(tied):
                break
            at = starts[tied] + k
            rank = refined(rank, tied, self.x[at] * wide + (self.x[at + 1] if k + 1 < modulus else 0))
        # then by doubling: behind a block of a sampled suffix stands a sampled one
        levels, step = [rank], modulus
        while len(tied := ties(rank)):
            to = self.held[np.minimum(starts[tied] + step, n)]
            rank = refined(rank, tied, np.where(to >= 0, rank[to] + 1, 0))
            levels.append(rank)
            step *= 2
        # no ties are left: the ranks are the places in the sorted sample
        self.place = rank
        order = np.empty(len(starts), dtype=np.int64)
        order[rank] = np.arange(len(starts))
        common = np.zeros(len(starts), dtype=np.int64)  # of each in the order with the one before it
        common[1:] = self._by_levels(starts[order[:-1]], starts[order[1:]], levels)
        self.table = [common.astype(np.int32 if n < 1 << 31 else np.int64)]
        while 2 << (len(self.table) - 1) <= len(starts):
            low, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(low[: len(low) - half], low[half:]))

    def _by_levels(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of sampled suffixes: equal blocks, longest first, then words."""
        a, b = a.copy(), b.copy()
        done = np.zeros(len(a), dtype=np.int64)
        for k in range(len(levels) - 1, -1, -1):
            i, j = self.held[np.minimum(a, self.n)], self.held[np.minimum(b, self.n)]
            same = (i >= 0) & (j >= 0) & (levels[k][i] == levels[k][j])
            size = np.where(same, self.modulus << k, 0)
            a, b, done = a + size, b + size, done + size
        return done + self._by_words(a, b, np.full(len(a), self.modulus))

    def _by_words(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words at a and b, up to ``most``; places beyond the end are equal to none."""
        out = np.zeros(len(a), dtype=np.int64)
        live = np.flatnonzero((a < self.n) & (b < self.n) & (most > 0))
        k = 0
        while len(live):
            live = live[self.x[a[live] + k] == self.x[b[live] + k]]
            out[live] = k = k + 1
            live = live[(a[live] + k < self.n) & (b[live] + k < self.n) & (most[live] > k)]
        return out

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and at b, a <> b."""
        shift = self.shift[a % self.modulus, (b - a) % self.modulus]
        out = self._by_words(a, b, shift)
        on = np.flatnonzero((out == shift) & (a + shift < self.n) & (b + shift < self.n))
        i = self.place[self.held[a[on] + shift[on]]]
        j = self.place[self.held[b[on] + shift[on]]]
        low, high = np.minimum(i, j) + 1, np.maximum(i, j)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            own = level == k
            row = self.table[k]
            out[on[own]] += np.minimum(row[low[own]], row[high[own] - (1 << k) + 1])
        return out
