"""Exact top-k by inner product, with a uniform threshold in three phases.

The components of a vector are cut into ``SLICES`` slices, and a score is the sum
of the slices' local scores.

1. Every task keeps, for each query and slice, a list of its best local scores, with
   every id once. The lists are merged per query and slice; the k-th best total among their
   vectors is a safe cutoff: no better vector has less.
2. The cutoffs go to the tasks. A vector of the answer has a local score of at
   least cutoff / slices in one slice or another, so tasks collect these entries.
3. Their remaining local scores are added, exactly, in the task that holds the
   vector, and those that reach the cutoff are ranked.

Queries are taken in blocks of about ``BLOCK``, by a hash of the id, after they
were counted: a block and its cutoffs are what tasks carry, and all that the
driver sees. Each block is two passes over the vectors. A task holds one Arrow
batch and block x slices x k list entries.

Defined cases: vectors that are null or hold a null or non-finite component, and
rows with a null id, take no part; vectors of different lengths do not score each
other; rows of one id are one candidate with its greatest score, and none for
the query of that id; equal query rows are one query, and of different vectors
of one id the smallest is the query; ties go to the smaller id; with fewer
candidates than k all are returned; an empty table gives an empty result; scores
beyond the range of long stop at its ends; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm import base

SLICES, TOP, BLOCK, SCALE = 4, 5, 1024, 256
#: Rows scored at a time.
ROWS = 2048
LOW = np.iinfo(np.int64).min


def whole_numbers(vectors: list) -> np.ndarray:
    """floor(SCALE * x) of vectors of one length: integers, as doubles where that is exact."""
    x = np.floor(np.array(vectors, dtype=np.float64).reshape(len(vectors), -1) * SCALE)
    return x if not x.size or np.abs(x).max() < 2**50 else np.array([[int(v) for v in r] for r in x], dtype=object)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows, exact, as int64."""
    if q.dtype != object and x.dtype != object and q.size and x.size:
        top = float(np.abs(q).max()) * float(np.abs(x).max()) * max(1, q.shape[1])
        if top < 2**53:
            return (q @ x.T).astype(np.int64)
    if not q.shape[1]:
        return np.zeros((len(q), len(x)), dtype=np.int64)
    exact = np.array([[int(v) for v in r] for r in q], dtype=object) @ np.array([[int(v) for v in r] for r in x], dtype=object).T
    return np.clip(exact, LOW + 1, np.iinfo(np.int64).max).astype(np.int64)


def by_length(batches):
    """(ids, whole numbers) of the vectors that take part, a length and up to ROWS at a time."""
    for b in batches:
        held: dict[int, tuple[list, list]] = {}
        for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if i is not None and v is not None and None not in v and np.isfinite(np.array(v, dtype=np.float64)).all():
                ids, own = held.setdefault(len(v), ([], []))
                ids.append(i)
                own.append(v)
                if len(ids) == ROWS:
                    yield np.array(ids), whole_numbers(own)
                    held.pop(len(v))
        for ids, own in held.values():
            yield np.array(ids), whole_numbers(own)


def slices_of(dimensions: int, slices: int) -> list[slice]:
    cuts = [dimensions * k // slices for k in range(slices + 1)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


class Queries:
    """A block of queries, by length of the vector."""

    def __init__(self, rows: list[tuple[int, list[float]]]):
        own: dict[int, tuple[list, list]] = {}
        for i, v in sorted({i: v for i, v in sorted(rows, reverse=True)}.items()):
            ids, held = own.setdefault(len(v), ([], []))
            ids.append(i)
            held.append(v)
        self.own = {n: (np.array(ids), whole_numbers(v)) for n, (ids, v) in own.items()}

    def local_scores(self, ids: np.ndarray, x: np.ndarray, slices: int):
        """(query ids, slices x queries x vectors local scores, which are the query's own)."""
        if x.shape[1] in self.own:
            qid, q = self.own[x.shape[1]]
            yield qid, np.stack([products(q[:, s], x[:, s]) for s in slices_of(x.shape[1], slices)]), qid[:, None] == ids


def best(scores: np.ndarray, ids: np.ndarray, totals: np.ndarray, k: int):
    """The k best columns of every row: scores, ids, totals."""
    if scores.shape[1] > k:
        at = np.argpartition(scores, scores.shape[1] - k, axis=1)[:, -k:]  # LOW has no negative
        return (np.take_along_axis(a, at, axis=1) for a in (scores, ids, totals))
    return scores, ids, totals


def by_id(ids: np.ndarray, *scores: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct ids, and of each the greatest of its columns."""
    order = np.argsort(ids, kind="stable")
    own = ids[order]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    if len(first) == len(ids):
        return ids, *scores
    return own[first], *(np.maximum.reduceat(s[:, order], first, axis=1) for s in scores)


def joined(old: tuple, new: tuple) -> tuple[np.ndarray, ...]:
    """Two lists as one: scores, ids, totals; an id that is in both stands once, with the greater values."""
    scores, ids, totals = (np.concatenate([a, b], axis=1) for a, b in zip(old, new, strict=True))
    order = np.argsort(ids, axis=1, kind="stable")
    scores, ids, totals = (np.take_along_axis(a, order, axis=1) for a in (scores, ids, totals))
    twice = ids[:, 1:] == ids[:, :-1]
    for a in (scores, totals):
        a[:, 1:] = np.where(twice, np.maximum(a[:, 1:], a[:, :-1]), a[:, 1:])
    scores[:, :-1][twice] = LOW
    return scores, ids, totals


LISTS = "query_id long, slice int, vec_id long, local long, score long"
FOUND = "query_id long, vec_id long, score long"


def first_lists(vectors: DataFrame, queries: Queries, k: int, slices: int) -> DataFrame:
    """Phase 1: each task's best local scores by query and slice, with the totals of their vectors."""

    def work(batches):
        lists: dict[int, list] = {}
        for ids, x in by_length(batches):
            for qid, local, own in queries.local_scores(ids, x, slices):
                total = np.where(own, LOW, local.sum(axis=0))
                once, total, *parts = by_id(ids, total, *(np.where(own, LOW, part) for part in local))
                wide = np.broadcast_to(once, total.shape)
                for s in range(slices):
                    new = tuple(best(parts[s], wide, total, k))
                    old = lists.get((x.shape[1], s))
                    lists[x.shape[1], s] = (qid, new if old is None else tuple(best(*joined(old[1], new), k)))
        for (_, s), (qid, (local, ids, total)) in lists.items():
            ok = local > LOW
            q = np.broadcast_to(qid[:, None], ids.shape)[ok]
            yield pa.RecordBatch.from_arrays(
                [pa.array(q), pa.array(np.full(len(q), s, np.int32)), pa.array(ids[ok]), pa.array(local[ok]), pa.array(total[ok])],
                names=["query_id", "slice", "vec_id", "local", "score"],
            )

    return vectors.mapInArrow(work, LISTS)


def sufficient(vectors: DataFrame, queries: Queries, cutoff: dict[int, int], slices: int) -> DataFrame:
    """Phases 2 and 3: vectors with one local score of cutoff / slices or more, whose total reaches the cutoff."""

    def work(batches):
        for ids, x in by_length(batches):
            for qid, local, own in queries.local_scores(ids, x, slices):
                cut = np.array([cutoff.get(int(q), LOW) for q in qid])[:, None]
                enough = (local.max(axis=0) >= cut // slices) & ~own
                r, c = np.nonzero(enough)
                total = local[:, r, c].sum(axis=0)
                ok = total >= cut[r, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qid[r[ok]]), pa.array(ids[c[ok]]), pa.array(total[ok])], names=["query_id", "vec_id", "score"]
                )

    return vectors.mapInArrow(work, FOUND)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = TOP, slices: int = SLICES, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` (vec_id, embedding) for each of ``queries``."""
    valid = (
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    vectors = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    queries = queries.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(valid)
    blocks = max(1, -(-queries.count() // block))
    found = None
    for b in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).collect()  # about ``block`` rows
        held = Queries([(r["vec_id"], list(r["embedding"])) for r in rows])
        lists = first_lists(vectors, held, k, slices)
        lists = lists.groupBy("query_id", "slice", "vec_id").agg(F.max("local").alias("local"), F.max("score").alias("score"))
        by_slice = Window.partitionBy("query_id", "slice").orderBy(F.desc("local"), "vec_id")
        merged = lists.withColumn("r", F.row_number().over(by_slice)).where(F.col("r") <= k)
        totals = merged.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        by_query = Window.partitionBy("query_id").orderBy(F.desc("score"))
        cuts = totals.withColumn("r", F.row_number().over(by_query)).where(F.col("r") == k).select("query_id", "score")
        cutoff = {r["query_id"]: r["score"] for r in cuts.collect()}  # one row a query of the block
        enough = sufficient(vectors, held, cutoff, slices)
        part = base.keep(enough.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
        found = part if found is None else found.unionByName(part)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op9_topk_uniform_threshold(spark, sf_dir: str) -> DataFrame:
    """The 5 best vectors for every vector whose id is divisible by 50."""
    vectors = base.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, max(list_inner_product(q.e, x.e)::BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id AND len(q.e) = len(x.e) WHERE q.vec_id % 50 = 0 GROUP BY ALL
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= {TOP}
"""
