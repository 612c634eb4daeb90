"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. An n-gram binds its
letters: their vectors, rotated by the place in the n-gram, are multiplied. A
document bundles its n-grams: their vectors are added, once per occurrence. A
language's prototype is the sum of its documents' vectors. A document is of the
language whose prototype makes the greatest cosine with the document's vector.

Letters are lower-cased; every run of other characters is one gap, and so are
the text's ends. Vectors of letters follow from the code point, so no table is
kept. Prototypes are integer sums over all learnable documents, added up by
Spark per (language, component): the driver gets languages x DIMENSIONS numbers.

Defined cases: null text and text without a letter give ``und`` with score 0, and
so does everything when nothing can be learnt; ties go to the language first in
order; a null doc_id counts as the empty text in crc32; equal rows give equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm import base

#: Components of a vector, a multiple of 64, and letters of an n-gram.
DIMENSIONS, LETTERS = 512, 3
UNDETERMINED = "und"
GAP = 32
#: Documents whose n-grams are looked at together.
AT_ONCE = 128


def mixed(x: np.ndarray) -> np.ndarray:
    """The public splitmix64 finalizer."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def letter_vectors(points: np.ndarray, dimensions: int) -> np.ndarray:
    """Rows of +1 and -1 for code points."""
    words = dimensions // 64
    seeds = points.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64)
    bits = np.unpackbits(mixed(seeds).astype("<u8").view(np.uint8).reshape(len(points), -1), axis=1)
    return (2 * bits.astype(np.int8) - 1).astype(np.int8)


class Encoder:
    """Texts to vectors."""

    def __init__(self, dimensions: int = DIMENSIONS, letters: int = LETTERS):
        self.dimensions, self.letters = dimensions, letters
        self.is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)

    def grams(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Distinct n-grams, as numbers of 21 bits a letter, and their counts."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letter = self.is_letter[points]
        if not letter.any():
            return None
        held = letter.copy()
        held[1:] |= letter[:-1]
        kept = np.where(letter, points, GAP)[held]
        kept = np.concatenate([[GAP], kept] if not letter[-1] else [[GAP], kept, [GAP]]).astype(np.uint64)
        if len(kept) < self.letters:
            kept = np.concatenate([kept, np.full(self.letters - len(kept), GAP, np.uint64)])
        code = np.zeros(len(kept) - self.letters + 1, dtype=np.uint64)
        for k in range(self.letters):
            code = (code << np.uint64(21)) | kept[k : len(kept) - self.letters + 1 + k]
        return np.unique(code, return_counts=True)

    def gram_vectors(self, codes: np.ndarray) -> np.ndarray:
        out = np.ones((len(codes), self.dimensions), dtype=np.int8)
        for k in range(self.letters):
            points = (codes >> np.uint64(21 * (self.letters - 1 - k))) & np.uint64(0x1FFFFF)
            own, where = np.unique(points, return_inverse=True)
            out *= np.roll(letter_vectors(own, self.dimensions), self.letters - 1 - k, axis=1)[where]
        return out.astype(np.float32)

    def batches(self, texts: list):
        """For AT_ONCE texts: (n-grams or None of each, vectors of all n-grams, row numbers in them)."""
        for a in range(0, len(texts), AT_ONCE):
            parts = [self.grams(t) if t else None for t in texts[a : a + AT_ONCE]]
            codes = [p[0] for p in parts if p]
            table, where = np.zeros((0, self.dimensions), dtype=np.float32), np.zeros(0, dtype=np.int64)
            if codes:
                own, where = np.unique(np.concatenate(codes), return_inverse=True)
                table = self.gram_vectors(own)
            yield parts, table, where

    def vectors(self, texts: list) -> list[np.ndarray | None]:
        """A vector of whole numbers for each text, None without a letter."""
        out: list[np.ndarray | None] = []
        for parts, table, where in self.batches(texts):
            at = 0
            for p in parts:
                if p is None:
                    out.append(None)
                    continue
                rows = where[at : at + len(p[0])]
                at += len(p[0])
                v = np.zeros(self.dimensions, dtype=np.float64)
                for k in range(0, len(rows), 8192):
                    v += weigh(p[1][k : k + 8192], table[rows[k : k + 8192]])
                out.append(v)
        return out

    def add_up(self, texts: list, names: list, total: dict[str, np.ndarray]) -> None:
        """Add the vectors of texts to the totals of their names, n-gram by n-gram."""
        for k, (parts, table, where) in enumerate(self.batches(texts)):
            own = [name for name, p in zip(names[k * AT_ONCE :], parts, strict=False) if p]
            sizes = [len(p[0]) for p in parts if p]
            counts = np.concatenate([p[1] for p in parts if p] or [np.zeros(0, np.int64)])
            of = np.repeat(np.array(own, dtype=object), sizes)
            for name in set(own):
                mine = of == name
                n = np.bincount(where[mine], weights=counts[mine], minlength=len(table))
                total[name] += weigh(n, table).astype(np.int64)


def weigh(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of rows times counts, exact: single precision below 2**24, double above."""
    kind = np.float32 if counts.sum() < 1 << 24 else np.float64
    return counts.astype(kind) @ rows


PARTS = T.StructType([
    T.StructField("lang", T.StringType()),
    T.StructField("component", T.IntegerType()),
    T.StructField("value", T.LongType()),
])


def learn(df: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototypes of the languages in ``df``; rows with a null in either column are left out."""

    def work(batches):
        encoder, total = Encoder(dimensions), defaultdict(lambda: np.zeros(dimensions, dtype=np.int64))
        for texts, langs in batches:
            encoder.add_up(texts, langs, total)
        for name, v in total.items():
            yield [(name, k, x) for k, x in enumerate(v.tolist())]

    known = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text), F.col(lang))
    sums = base.map_texts(known, work, PARTS).groupBy("lang", "component").agg(F.sum("value").alias("value"))
    out: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(dimensions))
    for r in sums.collect():  # languages x dimensions
        out[r["lang"]][r["component"]] = r["value"]
    return {k: out[k] for k in sorted(out)}


PREDICTED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def identify(df: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    """``df`` with struct column OUT: lang_pred and the cosine, 0 where it is negative."""
    names = list(prototypes)
    unit = np.array([p / max(1.0, np.linalg.norm(p)) for p in prototypes.values()]).reshape(-1, dimensions)

    def make():
        encoder = Encoder(dimensions)

        def work(texts: list) -> list[tuple]:
            rows = []
            for a in range(0, len(texts), AT_ONCE):
                for v in encoder.vectors(texts[a : a + AT_ONCE]):
                    if v is None or not names:
                        rows.append((UNDETERMINED, 0.0))
                        continue
                    cosine = unit @ v / max(1.0, np.linalg.norm(v))
                    k = int(cosine.argmax())
                    rows.append((names[k], float(min(1.0, max(0.0, cosine[k])))))
            return rows

        return work

    return base.with_rows(df, make, PREDICTED, df[text])


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text, modulo ``n``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def op2_language_hyperdimensional(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of them."""
    docs = base.table(spark, sf_dir, "documents")
    prototypes = learn(docs.where(remainder(docs["doc_id"], 4) != 2))
    return identify(docs.select("doc_id", "text"), prototypes).select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), f"{base.OUT}.*"
    )


def language_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents of an identifiable language; texts without a letter go.

    Where no language is known, nothing can be learnt, and documents with a letter stay.
    """
    prototypes = learn(docs)
    if not prototypes:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = identify(docs, prototypes)
    return found.where(F.col(base.OUT)["lang_pred"] != UNDETERMINED).drop(base.OUT)
