"""Word shingles of a text as 64-bit numbers.

Two different shingles have the same number with a chance of about 2**-57; sets
are told apart by a number over all of theirs and by their size.
"""

from __future__ import annotations

import numpy as np

from tripflow.llm.language_id import mixed

WORDS = 5


def odd(n: int, salt: int) -> np.ndarray:
    """``n`` fixed odd multipliers."""
    return mixed(np.arange(n, dtype=np.uint64) + np.uint64(salt)) | np.uint64(1)


class Shingler:
    def __init__(self, words: int = WORDS):
        self.words = words
        self.blank = np.zeros(256, dtype=bool)
        self.blank[[32, 9, 10, 11, 12, 13]] = True
        self.place = odd(64, 1 << 40)
        self.step = odd(words, 1 << 41)

    def of(self, text: str | None) -> np.ndarray:
        """The distinct shingles of a text, ascending."""
        if not text:
            return np.zeros(0, dtype=np.uint64)
        x = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
        full = np.concatenate([[False], ~self.blank[x], [False]])
        turn = np.flatnonzero(full[1:] != full[:-1])
        start, end = turn[::2], turn[1::2]
        if not len(start):
            return np.zeros(0, dtype=np.uint64)
        size = end - start
        if size.max() > len(self.place):
            self.place = odd(int(size.max()), 1 << 40)
        # only the bytes of words, each times the multiplier of its place in the word
        own = x[full[1:-1]].astype(np.uint64) + np.uint64(1)
        first = np.cumsum(size) - size
        own *= self.place[np.arange(len(own)) - np.repeat(first, size)]
        word = mixed(np.add.reduceat(own, first) ^ size.astype(np.uint64))
        n = len(word)
        if n < self.words:
            return mixed(np.array([np.sum(word * self.step[:n]) + np.uint64(n)], dtype=np.uint64))
        total = np.zeros(n - self.words + 1, dtype=np.uint64)
        for k in range(self.words):
            total += word[k : n - self.words + 1 + k] * self.step[k]
        return np.unique(mixed(total))


def set_number(shingles: np.ndarray) -> int:
    """A signed 64-bit number for a set of shingles and its size."""
    total = np.sum(mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5))) + np.uint64(len(shingles))
    return int(mixed(np.array([total], dtype=np.uint64)).view(np.int64)[0])
