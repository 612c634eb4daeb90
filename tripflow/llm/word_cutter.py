"""Texts cut into the words of a byte-level tokenizer's pattern, for many texts at once.

``PATTERN`` is cut by its meaning, with numpy over code points: runs of letters,
of numbers, of white space and of other characters are words; a run but a white one
takes one space before it; of a white run before another word the last character
stands apart; and the English endings after an apostrophe that begins a word are words.
Any other pattern is cut by the ``regex`` module, text by text.

What is a letter, a number or white space is asked of the tokenizer's own library, code
point by code point, so its Unicode version counts.

Equal words of a batch are found by two 64-bit numbers each, which agree for
different words with a chance of about 2**-100. A batch takes about 100 bytes for each
character, and holds ``CHARACTERS`` of them, or one longer text.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from tripflow.llm.language_id import mixed
from tripflow.llm.shingles import odd

#: Fixed value: the pattern that is cut by its meaning.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Characters of texts that are cut together.
CHARACTERS = 500_000


@lru_cache(1)
def classes() -> bytes:
    """The class of every code point, as one byte each."""
    import tiktoken

    points = np.arange(0x110000, dtype="<u4")
    points = points[(points < 0xD800) | (points >= 0xE000)]
    bytes_only = {bytes([b]): b for b in range(256)}
    out = np.zeros(0x110000, dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        library = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=bytes_only, special_tokens={})
        # some at a time, since this runs in the driver and the library gives a list
        for a in range(0, len(points), 1 << 14):
            found = bytes(library.encode_ordinary(points[a : a + (1 << 14)].tobytes().decode("utf-32-le"))).decode("utf-8")
            out[np.frombuffer(found.encode("utf-32-le"), dtype=np.uint32)] = kind
    return out.tobytes()


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start .. start + size - 1 of each, one after another."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


class Words:
    """The words of some texts: distinct ones with two numbers each, and which of them each word is."""

    def __init__(self, text: str, start: np.ndarray, end: np.ndarray, first: np.ndarray, h1, h2, codes, cuts):
        self._text, self._start, self._end, self._first = text, start, end, first
        self.h1, self.h2 = h1, h2
        #: distinct words by place, word after word of all texts, and where each text's begin
        self.codes, self.cuts = codes, cuts

    def __len__(self) -> int:
        return len(self.h1)

    def word(self, k: int) -> str:
        """The k-th distinct word."""
        i = int(self._first[k])
        return self._text[int(self._start[i]) : int(self._end[i])]

    def names(self, which: np.ndarray) -> pa.StringArray:
        """The distinct words at these places."""
        i = self._first[which]
        a, b, data = self._start[i], self._end[i], self._text.encode("utf-8")
        x = np.frombuffer(data, dtype=np.uint8)
        if len(data) > len(self._text):  # from characters to bytes
            at = np.append(np.flatnonzero((x & 0xC0) != 0x80), len(data))
            a, b = at[a], at[b]
        ends = np.concatenate([[0], np.cumsum(b - a)]).astype(np.int32)
        return pa.StringArray.from_buffers(len(which), pa.py_buffer(ends), pa.py_buffer(x[spread(a, b - a)]))


class Cutter:
    def __init__(self, pattern: str, table: bytes):
        self.pattern = pattern
        self.kinds = np.frombuffer(table, dtype=np.uint8)
        self.place = [odd(64, 1 << 42), odd(64, 1 << 43)]
        self._held: tuple | None = None
        if pattern != PATTERN:
            import regex

            self.regex = regex.compile(pattern)

    def _starts(self, text: str, x: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words; ``ends`` are those of the texts."""
        if self.pattern != PATTERN:
            spans, low = [], 0
            for high in ends.tolist():
                spans += [(m.start() + low, m.end() + low) for m in self.regex.finditer(text[low:high])]
                low = high
            both = np.array(spans, dtype=np.int64).reshape(-1, 2)
            return both[:, 0], both[:, 1]
        n = len(x)
        kind = self.kinds[x]
        fresh = np.zeros(n + 1, dtype=bool)  # a text begins here
        fresh[0] = True
        fresh[ends] = True
        run = fresh.copy()
        run[1:n] |= kind[1:] != kind[:-1]
        word = run[:n].copy()
        # the last character of a white run before another word
        last = (kind == SPACE) & run[1:] & ~fresh[1:]
        word |= last
        taken = np.flatnonzero(last & (x == 32)) + 1  # a space is the next word's
        word[taken] = False
        # endings after an apostrophe that is a run of its own and begins a word
        alone = word & (x == 39) & run[1:] & ~fresh[1:]
        at = np.flatnonzero(alone)
        if len(at):
            x2 = np.append(x, [0, 0, 0])
            letter, next_ = x2[at + 1], x2[at + 2]
            same = ~run[np.minimum(at + 2, n)]  # the next two are of one run
            two = same & (
                ((letter == ord("r")) & (next_ == ord("e"))) | ((letter == ord("v")) & (next_ == ord("e")))
                | ((letter == ord("l")) & (next_ == ord("l")))
            )
            one = np.isin(letter, [ord(c) for c in "stmd"])
            size = np.where(one, 1, np.where(two, 2, 0))
            own = size > 0
            word[at[own] + 1] = False
            rest = at[own] + 1 + size[own]
            rest = rest[rest < n]
            word[rest] = word[rest] | ~run[rest]
        start = np.flatnonzero(word)
        return start, np.append(start[1:], n)

    def cut(self, texts: list[str]) -> Words:
        text = "".join(texts)
        x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        if not len(x):
            none = np.zeros(0, dtype=np.int64)
            return Words(text, none, none, none, none.astype(np.uint64), none.astype(np.uint64), none, np.zeros(len(texts) + 1, dtype=np.int64))
        start, end = self._starts(text, x, ends)
        size = end - start
        numbers = [self._numbers(x, start, size, k) for k in range(2)]
        h1, first, codes = np.unique(numbers[0], return_index=True, return_inverse=True)
        h2 = numbers[1][first]
        if not (h2[codes] == numbers[1]).all():  # the first number alone doesn't tell all words apart
            both = np.rec.fromarrays(numbers)
            both, first, codes = np.unique(both, return_index=True, return_inverse=True)
            h1, h2 = both["f0"], both["f1"]
        cuts = np.concatenate([[0], np.searchsorted(start, ends, side="left")])
        return Words(text, start, end, first, h1, h2, codes, cuts)

    def numbered(self, words: list[str]) -> list[np.ndarray]:
        """The two numbers of words that are given."""
        x = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        size = np.array([len(w) for w in words], dtype=np.int64)
        return [self._numbers(x, np.cumsum(size) - size, size, k) for k in range(2)]

    def _numbers(self, x: np.ndarray, start: np.ndarray, size: np.ndarray, which: int) -> np.ndarray:
        if not len(start):
            return np.zeros(0, dtype=np.uint64)
        if size.max() > len(self.place[which]):
            self.place[which] = odd(int(size.max()), (1 << 42) << which)
        first = np.cumsum(size) - size
        if self._held is None or self._held[0] is not start:  # the places of the characters in the words
            step = np.ones(int(first[-1] + size[-1]), dtype=np.int64)
            step[first] = np.concatenate([[0], 1 - size[:-1]])
            self._held = (start, np.cumsum(step))
        inside = self._held[1]
        # words mostly follow each other without gaps
        own = x if len(x) == len(inside) else x[spread(start, size)]
        value = (own.astype(np.uint64) + np.uint64(1)) * self.place[which][inside]
        return mixed(np.add.reduceat(value, first) ^ size.astype(np.uint64))


def groups(sizes, most: int | None = None):
    """Slices of rows of these sizes: of ``most`` in sum (CHARACTERS), or of a single row each."""
    most, low, total = CHARACTERS if most is None else most, 0, 0
    for k, n in enumerate(sizes):
        if k > low and total + n > most:
            yield low, k
            low, total = k, 0
        total += n
    if low < len(sizes):
        yield low, len(sizes)
