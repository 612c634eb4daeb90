"""Benchmark decontamination by a prefix-filtered set join.

A *window* is ten consecutive words of a benchmark item, or the whole item if it
has fewer. Containment of a window is exact, so a necessary prefix of its words,
ordered by rarity, is a single word: the rarest. A document can hold the window
only if it holds that word. Words are therefore counted over all documents, each
window is listed under its rarest word, and a document's words are joined with
that list. The place of the rare word in the window says where the window would
begin; length and position bounds drop what would stick out; the rest is
verified word by word.

The benchmark is read in blocks of about ``BLOCK_CHARS`` characters, by a hash of
the item, after its size was measured: tasks carry the windows of one block. A
benchmark within the bound is one block. With several blocks, the spans found so
far are written to the shared folder between them, and the documents are read
once more for each block.

Defined cases: null and empty text and text without words have 0 words and no
hits; items that are null, without words or without an id have no windows; equal
ids of items count once; equal rows give equal results; an empty table gives an
empty result; an empty benchmark contaminates nothing; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm import base

#: Words of a window, and the bound of a block of the benchmark.
WINDOW, BLOCK_CHARS = 10, 4_000_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    """Words of a text, A-Z lower-cased."""
    if not text:
        return []
    if text.isascii():
        return WORD.findall(text.lower())
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def windows(items: list[tuple], size: int) -> dict[tuple[str, ...], set[str]]:
    """Distinct windows and the items that hold them."""
    out: dict[tuple[str, ...], set[str]] = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        if words:
            for k in range(max(1, len(words) - size + 1)):
                own = out[tuple(words[k : k + size])]
                if item is not None:  # a window of no named item is hit, and counts for no item
                    own.add(str(item))
    return out


COUNTED = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])


def counts(docs: DataFrame, column: str, vocabulary: frozenset[str]) -> dict[str, int]:
    """Occurrences of the words of a block in all documents."""

    def work(batches):
        total: Counter = Counter()
        for (texts,) in batches:
            for a in range(0, len(texts), 1000):
                own: Counter = Counter()
                for t in texts[a : a + 1000]:
                    own.update(words_of(t))
                for w in vocabulary & own.keys():
                    total[w] += own[w]
        yield list(total.items())

    got = base.map_texts(docs.select(column), work, COUNTED).groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in got.collect()}  # at most the block's words


class Index:
    """Windows by their rarest word; windows with a word that no document has are left out."""

    def __init__(self, held: dict[tuple[str, ...], set[str]], n: dict[str, int]):
        self.by_word: dict[str, list[tuple[int, list[str], list[str]]]] = defaultdict(list)
        for window, items in sorted(held.items()):
            rare = min(window, key=lambda w: (n.get(w, 0), w))
            if n.get(rare, 0):
                self.by_word[rare].append((window.index(rare), list(window), sorted(items)))
        self.by_word = dict(self.by_word)

    def find(self, words: list[str]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of words covered by windows, and the items of the windows."""
        spans, items = set(), set()
        rare = self.by_word.keys() & set(words)
        if rare:
            n = len(words)
            for i, w in enumerate(words):
                if w in rare:
                    for offset, window, own in self.by_word[w]:
                        start = i - offset
                        if start >= 0 and start + len(window) <= n and words[start : start + len(window)] == window:
                            spans.add((start, start + len(window)))
                            items.update(own)
        return sorted(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("starts", T.ArrayType(T.IntegerType())),
    T.StructField("ends", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def hits(
    docs: DataFrame, benchmark: DataFrame, column: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """``docs`` with struct column OUT: words, hit words, their spans, and the items (item_id, text) found."""
    size = benchmark.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_chars))
    out = docs
    for b in range(blocks):
        part = benchmark.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else benchmark
        held = windows([(r["item_id"], r["text"]) for r in part.select("item_id", "text").distinct().collect()], window)
        n = counts(docs, column, frozenset(w for x in held for w in x)) if held else {}
        index = Index(held, n)
        if b:
            out = base.keep(out)
            before = [out[base.OUT][k] for k in ("starts", "ends", "items")]
        else:
            before = []

        def make(index=index):
            def work(texts: list, *before: list) -> list[tuple]:
                rows = []
                for k, text in enumerate(texts):
                    words = words_of(text)
                    spans, items = index.find(words)
                    if before:
                        starts, ends, old = (x[k] for x in before)
                        spans += zip(starts, ends, strict=True)
                        items.update(old)
                    spans = merged(spans)
                    rows.append((
                        len(words), sum(e - s for s, e in spans), [s for s, _ in spans], [e for _, e in spans],
                        sorted(items),
                    ))
                return rows

            return work

        out = base.with_rows(out, make, HITS, out[column], *before)
    return out


def op4_decontaminate_prefix_join(spark, sf_dir: str) -> DataFrame:
    """Every document's words that stand in a window of a benchmark item."""
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = hits(docs, base.table(spark, sf_dir, "benchmark"))
    out = F.col(base.OUT)
    return found.select(
        "doc_id",
        out["n_words"].alias("n_words"),
        out["n_hit"].alias("n_hit"),
        F.size(out["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(out["items"], ","), 256).alias("items_sha256"),
        (out["n_hit"] > 0).alias("contaminated"),
    )


def decontaminate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark window go."""
    found = hits(docs, base.table(spark, sf_dir, "benchmark"))
    return found.where(F.col(base.OUT)["n_hit"] == 0).drop(base.OUT)
