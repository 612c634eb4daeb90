"""Runs of repeated words, and the extensions under them, against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.common import clashing, documents
from tripflow.llm import difference_cover, periodic_runs

SMALL = "/root/testdata/sf0.001"


def prefix(x, a, b):
    k = 0
    while max(a, b) + k < len(x) and x[a + k] == x[b + k]:
        k += 1
    return k


def plain_runs(words):
    """All maximal stretches by period, the smallest period of each."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    """The query's row, by its contract."""
    words = [w for w in (text or "").encode().translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = plain_runs(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()), sha(b" ".join(kept)),
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_cover_holds_every_difference_once():
    v, cover = difference_cover.MODULUS, difference_cover.COVER
    assert sorted((a - b) % v for a in cover for b in cover if a != b) == list(range(1, v))
    with pytest.raises(ValueError):
        difference_cover.shifts(31, (0, 1, 2))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=2, max_size=120), st.integers(1, 6), st.randoms(use_true_random=False))
def test_extensions(base, times, rnd):
    x = np.array(base * times)
    e = difference_cover.Extensions(x)
    pairs = [(a, b) for a, b in ((rnd.randrange(len(x)), rnd.randrange(len(x))) for _ in range(80)) if a != b]
    if pairs:
        a, b = np.array(pairs).T
        assert e.of(a, b).tolist() == [prefix(x, i, j) for i, j in pairs]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(
    st.lists(st.integers(1, 3), max_size=60), st.lists(st.integers(1, 3), min_size=1, max_size=9), st.integers(0, 9),
    st.lists(st.integers(1, 3), max_size=20),
), min_size=1, max_size=4))
def test_runs(parts):
    docs = [np.array(a + b * k + c, dtype=np.int64) for a, b, k, c in parts]
    doc, *run = periodic_runs.runs_of(docs)
    got = [[] for _ in docs]
    for d, *r in zip(doc.tolist(), *(c.tolist() for c in run), strict=True):
        got[d].append(tuple(r))
    assert got == [plain_runs(d.tolist()) for d in docs]


def test_grid_in_pieces(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PLACES", 7)
    docs = [np.array([1, 2, 3] * 30), np.array([5] * 50), np.zeros(0, dtype=np.int64), np.arange(1, 40)]
    doc, start, length, period = periodic_runs.runs_of(docs)
    assert list(zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist())) == [(0, 0, 90, 3), (1, 0, 50, 1)]


def test_limits():
    code = lambda *w: [np.array(w, dtype=np.int64)]
    found = lambda *w: list(zip(*(c.tolist() for c in periodic_runs.runs_of(code(*w))[1:])))
    assert found(*[1] * 5) == [] and found(*[1] * 6) == [(0, 6, 1)]
    assert found(*[1, 2] * 3, 1) == [] and found(*[1, 2] * 4) == [(0, 8, 2)]
    assert found(*[1, 1, 2] * 4) == [(0, 12, 3)]
    # a run inside a longer one of a larger period
    assert found(*([1] * 6 + [2]) * 4) == [(0, 6, 1), (0, 28, 7), (7, 6, 1), (14, 6, 1), (21, 6, 1)]


def test_longest_by_exact_ratio():
    assert periodic_runs.longest([(0, 9, 2), (9, 18, 4), (30, 10, 2), (50, 20, 4)]) == (30, 10, 2)
    assert periodic_runs.longest([]) is None


def test_query_against_brute_force(spark):
    got = rows(periodic_runs.op11_periodic_runs(spark, SMALL))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted((plain_row(*d) for d in docs), key=repr)
    assert any(r[1] for r in got)


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "WORDS", 500)
    long = " ".join(["w%d" % (i % 700) for i in range(20_000)])
    texts = [None, "", " \t\r\n ", "a", "a a a a a a", "a a a a a", "x\x0by\x0cx\ny x\ty x y", "           ",
             "é é é é é é é x", long, "a\x1cb " * 7, "A a A a A a A a"]
    data = [(i, t) for i, t in enumerate(texts)] + [(3, "a"), (4, "b b b b b b b b")]
    got = rows(periodic_runs.run_digests(periodic_runs.periodic_runs(clashing(documents(spark, data)), periodic_runs.repeated_tail)))
    assert got == sorted((plain_row(*d) for d in data), key=repr)


def test_null_id_and_empty_table(spark):
    found = periodic_runs.periodic_runs(documents(spark, [(None, "a b a b a b a b c")]), periodic_runs.repeated_tail)
    out = found.collect()[0]["__llm_out"]
    assert [tuple(r) for r in out.runs] == [(0, 8, 2)] and out.collapsed == "a b c"
    assert periodic_runs.run_digests(periodic_runs.periodic_runs(documents(spark, []))).collect() == []


def test_clashing_column_is_refused(spark):
    from pyspark.sql import functions as F

    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(documents(spark, [(1, "a")]).withColumn("__llm_out", F.lit(1)))
