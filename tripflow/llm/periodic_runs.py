"""Runs of repeated words: maximal stretches of four periods or more.

A document's words become numbers. For every period p the places 0, 3p, 6p, ... are
probed (the harmonic grid, n log n places in all): a stretch of at least 4p words
with period p holds such a place and the place p words on. From a pair of equal
words the longest common extensions to both sides give the whole stretch. They
come from ``difference_cover``, once for the words and once for the words reversed.
A stretch found with several periods keeps the smallest; it is found with that
one too, as the others are multiples of it.

The documents of an Arrow batch are put together, up to ``WORDS`` words, each
behind a number of its own that no extension crosses; a longer document goes
alone. Every document is worked on in one task, in rows of the input; nothing is
shuffled. Memory is in proportion to a batch or to the longest text, about 250 bytes
a word, and time is n log n also for a text of a single word repeated.

Defined cases: null, empty and blank texts have no words and no runs; equal rows
give equal results; an empty table gives an empty result; all columns of the input
are kept, and one named ``__llm_out`` is refused. White space is space and the five
ASCII controls from tab to carriage return. A null ``doc_id`` is rebuilt by no rule.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm import base
from tripflow.llm.difference_cover import Extensions

#: A run is at least so many periods long, and so many words.
PERIODS, LEAST = 4, 6
#: Words of documents that are worked on together, and grid places at a time.
WORDS, PLACES = 300_000, 4_000_000

RUN = "start: long, length: long, period: long"
SCHEMA = f"struct<runs: array<struct<{RUN}>>, best: struct<{RUN}>, collapsed: string>"
Rebuild = Callable[[int | None, list[bytes]], list[bytes]]


def grid(starts: np.ndarray, sizes: np.ndarray):
    """Arrays (place, period) of the probes of all documents, in pieces of about PLACES."""
    doc = np.repeat(np.arange(len(sizes)), sizes // PERIODS)
    before = np.cumsum(sizes // PERIODS) - sizes // PERIODS
    period = np.arange(len(doc)) - before[doc] + 1
    step = (PERIODS - 1) * period
    count = (sizes[doc] - period - 1) // step + 1
    done = np.cumsum(count)
    cuts = np.searchsorted(done, np.arange(PLACES, int(done[-1]) + PLACES, PLACES)) + 1 if len(done) else []
    low = 0
    for high in np.unique(np.minimum(cuts, len(doc))).tolist():
        own = slice(low, high)
        c = count[own]
        k = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        yield np.repeat(starts[doc[own]], c) + k * np.repeat(step[own], c), np.repeat(period[own], c)
        low = high


def runs_of(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, by document, start and period."""
    sizes = np.array([len(c) for c in codes], dtype=np.int64)
    most = max((int(c.max()) for c in codes if len(c)), default=0)
    x = np.concatenate([part for k, c in enumerate(codes) for part in (c, [most + 1 + k])])
    starts = np.cumsum(sizes + 1) - sizes - 1
    found = [np.zeros((3, 0), dtype=np.int64)]
    n, ahead, back = len(x), None, None
    for at, period in grid(starts, sizes):
        same = x[at] == x[at + period]
        at, period = at[same], period[same]
        if not len(at):
            continue
        if ahead is None:
            ahead, back = Extensions(x), Extensions(x[::-1])
        start = at - back.of(n - at, n - at - period)
        end = at + period + ahead.of(at, at + period)
        whole = (end - start >= PERIODS * period) & (end - start >= LEAST)
        found.append(np.unique(np.stack([start, end, period])[:, whole], axis=1))
    start, end, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    least = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[: len(start)]
    start, end, period = start[least], end[least], period[least]
    doc = np.searchsorted(starts, start, side="right") - 1
    order = np.lexsort((period, start))
    return doc[order], (start - starts[doc])[order], (end - start)[order], period[order]


def longest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length in periods; of equal ones the first."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words without what any run repeats, joined by spaces."""
    if runs:
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def batch_runs(documents: list[list[bytes]]) -> list[tuple]:
    """(runs, best run, collapsed text) of each document."""
    number = {w: i for i, w in enumerate(dict.fromkeys(w for d in documents for w in d), 1)}
    codes = [np.fromiter(map(number.__getitem__, d), dtype=np.int64, count=len(d)) for d in documents]
    doc, *run = runs_of(codes)
    held: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    for d, *r in zip(doc.tolist(), *(c.tolist() for c in run), strict=True):
        held[d].append(tuple(r))
    names = ("start", "length", "period")
    named = lambda r: dict(zip(names, r, strict=True)) if r else None
    return [
        ([named(r) for r in runs], named(longest(runs)), collapsed(words, runs))
        for words, runs in zip(documents, held, strict=True)
    ]


def periodic_runs(df: DataFrame, rebuild: Rebuild | None = None) -> DataFrame:
    """``df`` (doc_id, text, ...) with struct column OUT: runs, the longest in periods, and the text without repetitions.

    ``rebuild`` makes other words of a document's id and words before they are looked at.
    """

    def make():
        def work(ids: list, texts: list) -> list[tuple]:
            out, held, size = [], [], 0
            for doc_id, text in zip(ids, texts, strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                if rebuild is not None:
                    words = rebuild(doc_id, words)
                if held and size + len(words) > WORDS:
                    out.extend(batch_runs(held))
                    held, size = [], 0
                held.append(words)
                size += len(words)
            if held:
                out.extend(batch_runs(held))
            return out

        return work

    if base.OUT in df.columns:
        raise ValueError(f"a column {base.OUT} is not allowed")
    return base.with_rows(df, make, base.struct_of(SCHEMA), df["doc_id"], df["text"])


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's rebuilding: in a tenth of the documents the words from some place on repeat a stretch."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a : a + p]
    return words[:a] + (tail * (-(-(n - a) // p)))[: n - a]


def run_digests(found: DataFrame) -> DataFrame:
    """The query's columns of the result of ``periodic_runs``."""
    out, best = F.col(base.OUT), F.col(f"{base.OUT}.best")
    line = lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")
    )
    return found.select(
        "doc_id",
        F.size(out["runs"]).cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr(f"({base.OUT}.best.length * 1000) div {base.OUT}.best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(out["runs"], line), ""), 256).alias("runs_sha256"),
        F.sha2(out["collapsed"], 256).alias("collapsed_sha256"),
    )


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of every document's words, some of them rebuilt with a repeated tail."""
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    return run_digests(periodic_runs(docs, repeated_tail))
