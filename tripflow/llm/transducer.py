"""A merge tokenizer compiled to a deterministic transducer that counts tokens.

The tokenizer joins, again and again, the adjacent pair whose concatenation is
the best ranked piece, leftmost first. Such a tokenization is determined by
adjacent pairs: a sequence of pieces is the tokenization of its text if and only
if every piece tokenizes to itself and every two neighbours tokenize to
themselves. So the tokenization of a text's first i characters ends with the one
piece that fits the last piece of what stands before it, and what a longer text
needs to know of the first i characters is finite: for every start j of a piece
that could still be under way, the characters from j on, the last piece before j
and the number of tokens gained since j. That is a state. A transition reads one
character and is annotated with the tokens it adds, which may be negative when
it joins what was two tokens.

States and transitions are made when text first reaches them, and kept per task.
More than ``MOST_STATES`` are dropped and begun anew, which changes nothing but
time. A character that is in no piece gives its UTF-8 bytes as tokens and
leads back to the start, and so does every change from other characters to the
space mark, as no piece holds a space mark after another character.
"""

from __future__ import annotations

import numpy as np

SPACE = "▁"
#: States that a task holds, of about 400 bytes each with their transitions.
MOST_STATES = 400_000
#: Words up to this length run in step, longer ones alone.
IN_STEP = 32
START = (("", "", 0),)
#: Bits of a character's column in a transition's key.
BITS = 13


class Moves:
    """Transitions by state and character: an open hash table that is searched for many keys at once."""

    def __init__(self):
        self.bits, self.held = 16, 0
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.zeros(1 << self.bits, dtype=np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is, or the free place where it would be."""
        at = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            there = self.keys[at[left]]
            left = left[(there != keys[left]) & (there >= 0)]
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
        return at

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys, -1 where there is none."""
        at = self.places(keys)
        return np.where(self.keys[at] >= 0, self.values[at], -1)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Put in different new keys, one batch at a time."""
        while 2 * (self.held + len(keys)) > len(self.keys):
            old, kept = self.keys[self.keys >= 0], self.values[self.keys >= 0]
            self.bits += 1
            self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
            self.values = np.zeros(1 << self.bits, dtype=np.int64)
            self.put(old, kept)
        self.put(keys, values)
        self.held += len(keys)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        while len(keys):
            at = self.places(keys)
            own, first = np.unique(at, return_index=True)  # of keys with one free place the first gets it
            self.keys[own], self.values[own] = keys[first], values[first]
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, values = keys[rest], values[rest]


class Transducer:
    def __init__(self, ranked: list[str]):
        """ranked: pieces, best first."""
        self.rank = {p: i for i, p in enumerate(ranked)}
        if any(SPACE in p.lstrip(SPACE) for p in ranked):
            raise ValueError("a piece holds the space mark after another character")
        if len({c for p in ranked for c in p}) > (1 << BITS) - 8:
            raise ValueError("too many different characters")
        self.prefix = {x: x for p in ranked for x in (p[:k] for k in range(1, len(p)))}
        self.piece = {p: p for p in ranked}
        self.letters = {c for p in ranked for c in p}
        self.fits_memo: dict[tuple[str, str], bool] = {}
        self.alone_memo: dict[str, bool] = {}
        self.column = np.full(0x110000, -1, dtype=np.int16)
        self.chars: list[str] = []
        self.foreign: dict[int, int] = {}
        self.reset()

    # --- the tokenizer itself, for short strings

    def tokenize(self, text: str) -> list[str]:
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def alone(self, piece: str) -> bool:
        ok = self.alone_memo.get(piece)
        if ok is None:
            ok = self.alone_memo[piece] = piece in self.rank and self.tokenize(piece) == [piece]
        return ok

    def fits(self, left: str, right: str) -> bool:
        if not left:
            return True
        key = (left, right)
        ok = self.fits_memo.get(key)
        if ok is None:
            if len(self.fits_memo) > 500_000:
                self.fits_memo.clear()
            ok = self.fits_memo[key] = self.tokenize(left + right) == [left, right]
        return ok

    # --- states and transitions

    def reset(self) -> None:
        self.states = [START]
        self.number = {START: 0}
        self.moves = Moves()

    def character(self, c: str) -> int:
        """Column of a character; those in no piece share one for each length in bytes."""
        k = int(self.column[ord(c)])
        if k < 0:
            size = 0 if c in self.letters else len(c.encode("utf-8", "surrogatepass"))
            k = self.foreign.get(size, -1)
            if k < 0:
                k = len(self.chars)
                self.chars.append(c)
                if size:
                    self.foreign[size] = k
            self.column[ord(c)] = k
        return k

    def follow(self, state: tuple, c: str) -> tuple[tuple, int]:
        """The state after ``c``, and the tokens it adds."""
        if c not in self.letters:
            return START, len(c.encode("utf-8", "surrogatepass"))
        gain = piece = None
        for text, last, since in state:  # longest first
            new = text + c
            if self.alone(new) and self.fits(last, new):
                gain, piece = 1 - since, new
                break
        if piece is None:
            raise RuntimeError(f"no piece ends here: {state} {c!r}")
        begun = [(self.prefix.get(t + c), last, since + gain) for t, last, since in state]
        return (*(x for x in begun if x[0]), ("", self.piece[piece], 0)), gain

    def step(self, s: int, c: str) -> tuple[int, int]:
        """(state number, tokens added) after a character."""
        state, gain = self.follow(self.states[s], c)
        return self.state_number(state), gain

    def make_moves(self, keys: np.ndarray) -> None:
        """Transitions that are not there yet."""
        own = np.unique(keys)
        made = [self.step(k >> BITS, self.chars[k & ((1 << BITS) - 1)]) for k in own.tolist()]
        self.moves.add(own, np.array([(t << 8) | (gain + 128) for t, gain in made], dtype=np.int64))

    # --- running

    def run_rows(self, rows: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        """States and tokens after each character of rows, longest first, all from the start state."""
        length = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        codes = np.array(rows, dtype=f"U{width}").view(np.uint32).reshape(-1, width)
        states = np.zeros((len(rows), width + 1), dtype=np.int32)
        tokens = np.zeros((len(rows), width + 1), dtype=np.int32)
        for p in range(int(length[0])):
            m = int(np.searchsorted(-length, -p, side="left"))  # rows longer than p come first
            at, code = states[:m, p], codes[:m, p]
            for c in set(code[self.column[code] < 0].tolist()):
                self.character(chr(c))
            keys = (at.astype(np.int64) << BITS) | self.column[code]
            to = self.moves.find(keys)
            if (to < 0).any():
                self.make_moves(keys[to < 0])
                to = self.moves.find(keys)
            states[:m, p + 1] = to >> 8
            tokens[:m, p + 1] = tokens[:m, p] + (to & 255) - 128
        return states, tokens

    def count_words(self, words: list[str], at_once: int = 4096) -> np.ndarray:
        """Tokens of words that each begin at the start state."""
        n = np.zeros(len(words), dtype=np.int64)
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        long = 0
        while long < len(order) and len(words[order[long]]) > IN_STEP:
            n[order[long]] = self.count_long(words[order[long]])
            long += 1
        for a in range(long, len(order), at_once):
            part = order[a : a + at_once]
            self.make_room()
            length = np.array([len(words[i]) for i in part])
            _, tokens = self.run_rows([words[i] for i in part], IN_STEP)
            n[part] = tokens[np.arange(len(part)), length]
        return n

    def count_long(self, word: str, at_once: int = 4096) -> int:
        """Tokens of a long word: chunks run in step from the start state, then joined one after another.

        This is no parallel prefix scan: no map from entry to exit states is made.
        Entered from another state, a chunk is read again only until the two paths
        meet, a few characters as a rule; where they do not meet, to its end.
        """
        state, total = START, 0
        for a in range(0, len(word), IN_STEP * at_once):
            self.make_room()
            part = word[a : a + IN_STEP * at_once]
            chunks = [part[k : k + IN_STEP] for k in range(0, len(part), IN_STEP)]
            states, tokens = self.run_rows(chunks, IN_STEP)
            s = self.state_number(state)
            for k, chunk in enumerate(chunks):
                p = 0
                while p < len(chunk) and s != states[k, p]:
                    s, gain = self.step(s, chunk[p])
                    total += gain
                    p += 1
                if p < len(chunk):
                    total += int(tokens[k, len(chunk)] - tokens[k, p])
                    s = int(states[k, len(chunk)])
            state = self.states[s]
        return total

    def state_number(self, state: tuple) -> int:
        s = self.number.get(state, -1)
        if s < 0:
            s = self.number[state] = len(self.states)
            self.states.append(state)
        return s

    def make_room(self) -> None:
        if len(self.states) > MOST_STATES:
            self.reset()
