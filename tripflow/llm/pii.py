"""Personal data in texts: patterns, and a skip-chain conditional random field over them.

The *base* spans come from four patterns and their checks. The field then labels
the *candidates* of a document, its white-space separated tokens with a digit
or an ``@`` (all other tokens are outside by definition):

* unary potentials are a softmax over the candidate's shape, its tokens' counts
  of digits, dots and the like;
* chain potentials join candidates that are neighbours in the text;
* skip potentials join each candidate with the next one of the document that is
  equal or similar (same digits, or same word without case and punctuation),
  however far away. A group of n similar tokens makes n - 1 edges.

Loopy sum-product messages run for a fixed number of rounds over all three.
Candidates inside a base span are observed. A candidate decoded as personal data
outside the base spans adds a span, if it could be a whole value of its kind. So a card number whose pattern match fails at
one place, as digits stand before it, is still found there if the document
holds it elsewhere.

The potentials are learnt from the base spans of all documents. Tasks count
(shape, label) and (edge, label, label); only those counts, bounded by the
number of shapes, reach the driver.

Defined cases: null and empty text give no spans; equal rows give equal results;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm import base

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)  # 0 is outside
CHAIN, SKIP = 0, 1

# Possessive forms of the patterns: the same matches, in linear time. An address
# is found from its "@", since its local part can only end there.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CANDIDATE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
WORTH = re.compile(r"[0-9@]")

#: Rounds of message passing, its damping, and the belief that a label needs.
ROUNDS, DAMPING, BELIEF = 8, 0.3, 0.5
#: Log potential of an observed label.
OBSERVED = 12.0


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = 2 * v - 9 * (v > 4)
        total += v
    return total % 10 == 0


def emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        done = max(done, at + 1)
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the four patterns, ordered."""
    if not WORTH.search(text):
        return []
    spans = [(s, 0, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            spans.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 40:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def edges_of(core: str) -> tuple[int, int]:
    """Bounds of a token without the punctuation around it; a leading + stays."""
    a, b = 0, len(core)
    while a < b and not (core[a].isalnum() or core[a] == "+"):
        a += 1
    while b > a and not core[b - 1].isalnum():
        b -= 1
    return a, b


def shape(core: str) -> int:
    """The shape of a token as one number: digits, dots, dashes, @, +, letters, dotted quad."""
    digits = sum("0" <= c <= "9" for c in core)
    many = sum(digits > x for x in (0, 3, 7, 9, 13, 19))
    at = core.find("@")
    quad = core.count(".") == 3 and bool(IP.fullmatch(core))
    parts = (
        (many, 7),
        (min(core.count("."), 4), 5),
        (min(core.count("-"), 3), 4),
        ((at >= 0) + (at > 0 and "." in core[at:]), 3),
        (core[:1] == "+", 2),
        (any(c.isalpha() for c in core), 2),
        (quad, 2),
    )
    number = 0
    for value, size in parts:
        number = number * size + int(value)
    return number


#: Sizes of the parts of a shape, for its one-hot features.
SIZES = (7, 5, 4, 3, 2, 2, 2)


def one_hot(shapes: np.ndarray) -> np.ndarray:
    """Features of shapes: each part, and digits with each other part."""
    left, parts = shapes.astype(np.int64), []
    for size in reversed(SIZES):
        parts.append(left % size)
        left = left // size
    parts = parts[::-1]
    blocks = [np.eye(s)[p] for s, p in zip(SIZES, parts, strict=True)]
    blocks += [np.eye(SIZES[0] * s)[parts[0] * s + p] for s, p in zip(SIZES[1:], parts[1:], strict=True)]
    return np.concatenate([np.ones((len(shapes), 1)), *blocks], axis=1)


def similar_key(core: str) -> str:
    digits = "".join(c for c in core if "0" <= c <= "9")
    return digits if len(digits) >= 6 else core.lower()


class Graph:
    """Candidates of one text, its edges and its base spans."""

    def __init__(self, text: str):
        self.text, self.base = text, base_spans(text)
        self.nodes: list[tuple[int, int]] = []
        self.shapes: list[int] = []
        self.seen: list[int] = []
        self.edges: list[tuple[int, int, int]] = []
        if not WORTH.search(text):
            return
        last: dict[str, int] = {}
        before, k = -1, 0
        ordered = sorted(self.base, key=lambda x: x[2])
        for m in CANDIDATE.finditer(text):
            token = m.group()
            a, b = edges_of(token)
            if a == b:
                continue
            core, i = token[a:b], len(self.nodes)
            start, end = m.start() + a, m.start() + b
            while k < len(ordered) and ordered[k][2] <= start:
                k += 1
            label = next((1 + x[1] for x in ordered[k : k + 4] if x[0] < end), 0)
            self.nodes.append((start, end))
            self.shapes.append(shape(core))
            self.seen.append(label)
            if i and m.start() - before <= 3 and text[before : m.start()].isspace():
                self.edges.append((i - 1, i, CHAIN))
            before = m.end()
            key = similar_key(core)
            if key in last:
                self.edges.append((last[key], i, SKIP))
            last[key] = i


# --- learning -------------------------------------------------------------------------------------

COUNTS = T.StructType([T.StructField(c, T.LongType()) for c in ("what", "a", "b", "n")])
UNARY = 2


def counted(batches):
    """Counts of (shape, label) and of (edge, label, label) of a partition."""
    total: Counter = Counter()
    for (texts,) in batches:
        for text in texts:
            if text:
                g = Graph(text)
                total.update((UNARY, s, y) for s, y in zip(g.shapes, g.seen, strict=True))
                total.update((t, g.seen[i], g.seen[j]) for i, j, t in g.edges)
    yield [(*k, n) for k, n in total.items()]


class Potentials:
    """Log potentials: by shape, and one square table for each type of edge."""

    def __init__(self, rows: list[tuple[int, int, int, int]], steps: int = 400, rate: float = 1.0):
        shapes = sorted({a for what, a, _, _ in rows if what == UNARY})
        at = {s: i for i, s in enumerate(shapes)}
        seen = np.zeros((len(shapes), LABELS))
        pairs = np.zeros((2, LABELS, LABELS))
        for what, a, b, n in rows:
            if what == UNARY:
                seen[at[a], b] += n
            else:
                pairs[what, a, b] += n
                pairs[what, b, a] += n
        x = one_hot(np.array(shapes, dtype=np.int64)) if shapes else np.zeros((0, 1))
        # weighted softmax regression; a log keeps frequent shapes from drowning the others
        total = seen.sum(axis=1, keepdims=True)
        y = (seen + 0.05) / (total + 0.05 * LABELS)
        weight = np.log1p(total)
        w = np.zeros((x.shape[1], LABELS))
        for _ in range(steps if shapes else 0):
            p = np.exp(x @ w)
            p /= p.sum(axis=1, keepdims=True)
            w -= rate * (x.T @ (weight * (p - y)) / weight.sum() + 1e-5 * w)
        self.w = w
        # pointwise mutual information of the labels of joined candidates
        joint = pairs + 0.5
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        self.pairs = np.log(joint) - np.log(joint.sum(axis=2, keepdims=True)) - np.log(joint.sum(axis=1, keepdims=True))

    def unary(self, shapes: np.ndarray) -> np.ndarray:
        if self.w.shape[0] == 1:
            return np.zeros((len(shapes), LABELS))
        z = one_hot(shapes) @ self.w
        return z - np.logaddexp.reduce(z, axis=1, keepdims=True)


def fit(df: DataFrame, column: str = "text") -> Potentials:
    """Potentials learnt from the base spans of every text of ``df``."""
    parts = base.map_texts(df.select(column), counted, COUNTS)
    # at most (number of shapes x labels) rows: the shapes are a fixed set of 6,720
    rows = parts.groupBy("what", "a", "b").agg(F.sum("n").alias("n")).collect()
    return Potentials(sorted(tuple(r) for r in rows))


# --- inference ------------------------------------------------------------------------------------


def beliefs(unary: np.ndarray, edges: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Label probabilities after loopy message passing. edges: rows of (i, j, type)."""
    if len(edges):
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        table = pairs[np.concatenate([edges[:, 2]] * 2)]
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        sent = np.zeros((len(source), LABELS))
        for _ in range(ROUNDS):
            b = unary.copy()
            np.add.at(b, target, sent)
            out = b[source] - sent[back]
            new = np.logaddexp.reduce(out[:, :, None] + table, axis=1)
            new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
            sent = DAMPING * sent + (1 - DAMPING) * new
        unary = unary.copy()
        np.add.at(unary, target, sent)
    return np.exp(unary - np.logaddexp.reduce(unary, axis=1, keepdims=True))


def whole(text: str, kind: int) -> bool:
    """Could the text be a complete value of the kind, and not a part of one?"""
    digits = sum("0" <= c <= "9" for c in text)
    if kind == 0:
        return "." in text[text.find("@") + 1 :] and 0 < text.find("@")
    if kind == 1:
        return text.count(".") == 3 and digits >= 4
    return 14 <= digits <= 19 if kind == 2 else 10 <= digits <= 15


def added(graphs: list[Graph], model: Potentials) -> list[list[tuple[int, int, int]]]:
    """Spans that the field adds to each text, not touching its base spans."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in graphs]
    live = [(k, g) for k, g in enumerate(graphs) if g.nodes]
    if not live:
        return out
    first = np.cumsum([0] + [len(g.nodes) for _, g in live])
    shapes = np.concatenate([np.array(g.shapes, dtype=np.int64) for _, g in live])
    seen = np.concatenate([np.array(g.seen) for _, g in live])
    edges = [np.array(g.edges, dtype=np.int64) + [o, o, 0] for (_, g), o in zip(live, first, strict=False) if g.edges]
    unary = model.unary(shapes)
    marked = seen > 0
    unary[marked, seen[marked]] += OBSERVED
    p = beliefs(unary, np.concatenate(edges) if edges else np.zeros((0, 3), np.int64), model.pairs)
    best = p.argmax(axis=1)
    hit = (best > 0) & (p[np.arange(len(p)), best] >= BELIEF) & ~marked
    for n, (k, g) in enumerate(live):
        joined = {j for i, j, t in g.edges if t == CHAIN}
        for j in np.flatnonzero(hit[first[n] : first[n + 1]]):
            start, end = g.nodes[j]
            kind = int(best[first[n] + j]) - 1
            if j in joined and out[k] and out[k][-1][1] == kind and out[k][-1][2] == g.nodes[j - 1][1]:
                start = out[k].pop()[0]
            out[k].append((start, kind, end))
        out[k] = [x for x in out[k] if whole(g.text[x[0] : x[2]], x[1])]
    return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SPANS = T.ArrayType(
    T.StructType([
        T.StructField("start", T.IntegerType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
    ])
)
FOUND = T.StructType([T.StructField("base", SPANS), T.StructField("added", SPANS)])


def detect(df: DataFrame, column: str = "text", model: Potentials | None = None) -> DataFrame:
    """``df`` with struct column OUT: base and added spans of every text."""
    model = model or fit(df, column)

    def make():
        def work(texts: list) -> list[tuple]:
            rows = []
            for k in range(0, len(texts), 256):
                graphs = [Graph(t or "") for t in texts[k : k + 256]]
                rows += [
                    ([dict(zip(("start", "kind", "end"), s, strict=True)) for s in g.base],
                     [dict(zip(("start", "kind", "end"), s, strict=True)) for s in more])
                    for g, more in zip(graphs, added(graphs, model), strict=True)
                ]
            return rows

        return work

    return base.with_rows(df, make, FOUND, df[column])


def op1_pii_skip_chain(spark, sf_dir: str) -> DataFrame:
    """Every document's personal data: counts and digest of the base spans, and all spans."""
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs)

    def make():
        def work(texts: list) -> list[tuple]:
            rows = []
            for k in range(0, len(texts), 256):
                graphs = [Graph(t or "") for t in texts[k : k + 256]]
                for g, more in zip(graphs, added(graphs, model), strict=True):
                    n = Counter(x[1] for x in g.base)
                    digest = hashlib.sha256(listed(g.base).encode()).hexdigest()
                    rows.append((*(n[i] for i in range(4)), digest, listed(sorted(g.base + more)), len(more)))
            return rows

        return work

    schema = T.StructType(
        [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
        + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
           T.StructField("n_added", T.LongType())]
    )
    return base.with_rows(docs, make, schema, docs["text"]).select("doc_id", f"{base.OUT}.*")
