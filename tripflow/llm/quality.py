"""Quality classifier: supervised subword embeddings.

A document is a bag of hashed n-grams: its words and word pairs, and its
character n-grams of 3 and 4. Each bucket has a learnt vector; a document's
vector is the mean over its n-grams, and a softmax layer gives the score. Both
are trained by stochastic gradient descent in numpy.

Training reads at most ``PER_LABEL`` documents of each label, those with the
smallest hash of the id; their bags, each at most ``BUCKETS`` numbers, come to the
driver. The share of the labels among all learnable rows is counted exactly and
put back into the score. Scoring reads whole texts; since it is linear in the
bag before the softmax, tasks carry one number for each bucket.

Defined cases: null and empty text have only the document mark, which every bag
holds; without any label the score is 0.5, with one label only it is that
label's share (0 or 1); several labels of one id count as several rows; a null
doc_id counts as the empty text in crc32 and has no label; equal texts get equal
scores; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm import base
from tripflow.llm.language_id import remainder

#: Documented bound of the training sample, documents for each label.
PER_LABEL = 1500
BUCKETS, SIZE = 1 << 16, 16
EPOCHS, RATE = 12, 0.5
MARK, AGAIN = 0, 1  # buckets of every document, and of every word that follows itself


def hashed(parts: list[np.ndarray], salt: int) -> np.ndarray:
    """Bucket numbers of rows of whole numbers, one array for each column."""
    h = np.full(len(parts[0]), salt, dtype=np.uint64)
    for x in parts:
        h = (h ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(BUCKETS - 2)).astype(np.int64) + 2


def bag(text: str) -> np.ndarray:
    """Bucket of every n-gram of a text, the mark first."""
    out = [np.array([MARK])]
    if text:
        x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        for n in (3, 4):
            if len(x) >= n:
                out.append(hashed([x[k : len(x) - n + 1 + k] for k in range(n)], n))
        blank = (x == 32) | ((x >= 9) & (x <= 13))
        start = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
        if len(start):
            # a word's number: its characters times powers of an odd number, added up
            run = np.where(blank, np.uint64(0), x + np.uint64(1))
            first = start if start[0] == 0 else np.append(0, start)
            place = np.arange(len(x)) - np.repeat(first, np.diff(first, append=len(x)))
            power = np.cumprod(np.full(int(place.max()) + 1, 0x5851F42D4C957F2D, dtype=np.uint64))
            word = np.add.reduceat(run * power[place], start)
            out.append(hashed([word], 1))
            if len(word) > 1:
                pair = hashed([word[:-1], word[1:]], 2)
                pair[word[:-1] == word[1:]] = AGAIN
                out.append(pair)
    return np.concatenate(out)


class Model:
    """One number for each bucket, a bias, and the shift to the true share of the labels."""

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight.astype(np.float32), bias

    def score(self, text: str) -> float:
        z = float(self.weight[bag(text)].mean(dtype=np.float64)) + self.bias
        return float(1 / (1 + np.exp(-min(max(z, -700.0), 700.0))))


def train(bags: list[tuple[np.ndarray, np.ndarray, int]], share: float, seed: int = 7) -> Model:
    """Embeddings and softmax layer by stochastic gradient descent, one document a step."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    layer, bias = np.zeros((SIZE, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            ids, part, label = bags[i]
            rate = RATE * (1 - done / steps)
            done += 1
            rows = vectors[ids]
            hidden = part @ rows
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = layer @ p
            layer -= rate * np.outer(hidden, p)
            bias -= rate * p
            # a bucket's share of the mean is small; the step is scaled back up by its root
            vectors[ids] = rows - rate * np.outer(np.sqrt(part), back).astype(np.float32)
    seen = sum(x[2] for x in bags) / len(bags)
    shift = np.log(share / (1 - share)) - np.log(seen / (1 - seen))
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0] + shift))


BAGS = T.StructType([
    T.StructField("ids", T.BinaryType()),
    T.StructField("counts", T.BinaryType()),
    T.StructField("label", T.IntegerType()),
])


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """A model of ``labels`` (doc_id, label 0 or 1) over ``docs`` (doc_id, text)."""
    labels = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    share = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(share) < 2:
        known = next(iter(share), None)
        return Model(np.zeros(BUCKETS), 0.0 if known is None else (700.0 if known else -700.0))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    few = [labels.where(F.col("label") == y).orderBy(*order).limit(per_label) for y in (0, 1)]
    sample = few[0].unionByName(few[1])  # at most 2 * per_label rows

    def work(batches):
        for texts, ys in batches:
            rows = []
            for text, y in zip(texts, ys, strict=True):
                ids, counts = np.unique(bag(text or ""), return_counts=True)
                rows.append((ids.astype("<i4").tobytes(), counts.astype("<i4").tobytes(), y))
            yield rows

    # many rows may have a sampled id: one text of each id and label, that of the least hash, comes to the driver
    taken = docs.join(F.broadcast(sample.distinct()), "doc_id").groupBy("doc_id", "label").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")
    ).select("text", "label")
    got = sorted(zip(*base.map_texts(taken, work, BAGS).toArrow().to_pydict().values(), strict=True))  # tasks end in any order
    bags = []
    for ids, counts, y in got:
        n = np.frombuffer(counts, dtype="<i4").astype(np.float32)
        bags.append((np.frombuffer(ids, dtype="<i4"), n / n.sum(), y))
    if len({b[2] for b in bags}) < 2:
        return Model(np.zeros(BUCKETS), float(np.log(share[1] / share[0])))
    return train(bags, share[1] / (share[0] + share[1]))


SCORED = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with struct column OUT: score and prediction."""

    def make():
        def work(texts: list) -> list[tuple]:
            scores = (model.score(t or "") for t in texts)
            return [(s, int(s >= 0.5)) for s in scores]

        return work

    return base.with_rows(df, make, SCORED, df[text])


def op5_quality_subword(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from two thirds of the labels."""
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = base.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    model = fit(docs, labels.where(remainder(F.col("doc_id"), 3) != 1))
    return score(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), f"{base.OUT}.*"
    )
