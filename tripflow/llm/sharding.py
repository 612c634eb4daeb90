"""Shards by a Feistel permutation of global row numbers.

The rows get numbers from 0 in the order of (doc_id, size, checksum, text hash),
whatever files they lie in. A Feistel network with ``ROUNDS`` keyed rounds permutes
0 .. 4^k - 1, the least such range that holds all N numbers; a number that is taken
beyond N walks on through the network until it comes back below (cycle walking,
under four steps on average). The permuted number q tells shard q mod S and slot
q div S. So the shuffle is reproducible from the seed, the sizes of shards differ by
one row at most and slots have no gaps; and ``row_of`` computes the row number in any
shard and slot, without a table.

Only ids, sizes and hashes are shuffled, into range partitions by the order, once;
texts stay where they are read. Rows alike in all of these are told apart by
their place in the input, so a group of copies is split like any other
rows; which of them has which number makes no difference to the result. The counts
of the range partitions are all that comes to the driver.

Defined cases: a null text has no bytes, so size 1 and checksum 0; a null doc_id comes
first in the order; repeated rows are rows of their own; long texts are only
hashed; an empty table gives an empty result; columns of the input other than
those of ``ROW`` are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.numbering import number_rows
from tripflow.llm import base
from tripflow.llm.language_id import mixed

#: Rounds of the network, the seed of its keys, and the shards of the query.
ROUNDS, SEED, SHARDS = 6, 2024, 8
ROW = ("doc_id", "text")


class Feistel:
    """A permutation of 0 .. n - 1, and its inverse."""

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS):
        if not 0 <= n <= 1 << 62:
            raise ValueError("0 to 2**62 rows")
        self.n = n
        self.half = 1
        while 1 << (2 * self.half) < n:
            self.half += 1
        self.keys = mixed(np.arange(rounds, dtype=np.uint64) + mixed(np.array([seed], dtype=np.uint64)))

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        return mixed(x ^ key) & np.uint64((1 << self.half) - 1)

    def _once(self, x: np.ndarray, forward: bool) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for key in self.keys if forward else self.keys[::-1]:
            if forward:
                left, right = right, left ^ self._round(right, key)
            else:
                left, right = right ^ self._round(left, key), left
        return (left << half) | right

    def _walk(self, x: np.ndarray, forward: bool) -> np.ndarray:
        x = np.asarray(x, dtype=np.int64)
        if len(x) and not (0 <= int(x.min()) and int(x.max()) < self.n):
            raise ValueError("a number is not in the range")
        out = self._once(x.astype(np.uint64), forward)
        # ends, since a cycle of the permutation comes back to the number itself, which is in the range
        while len(beyond := np.flatnonzero(out >= np.uint64(self.n))):
            out[beyond] = self._once(out[beyond], forward)
        return out.astype(np.int64)

    def of(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, True)

    def inverse(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, False)


def row_of(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The row number at a place: what a reader needs to resume or to seek."""
    return int(Feistel(n, seed).inverse(np.array([slot * shards + shard]))[0])


def permuted(row: Column, n: int, seed: int = SEED) -> Column:
    """The permuted row numbers."""

    @F.arrow_udf("bigint")
    def run(numbers: pa.Array) -> pa.Array:
        return pa.array(Feistel(n, seed).of(numbers.to_numpy(zero_copy_only=False)))

    return run(row)


def shard_rows(df: DataFrame, order: list[Column | str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``shard`` and ``slot``: a reproducible shuffle of its rows in the order given.

    Rows that ``order`` doesn't tell apart are numbered among themselves by their
    place in ``df``, which should read files: its rows then come in a fixed order.
    ``df`` is written to the shared folder, so it should be narrow.
    """
    place = df.withColumn("__at", F.monotonically_increasing_id())
    numbered = number_rows(place, [*order, "__at"], "__row").drop("__at")
    n = numbered.count()
    q = permuted(F.col("__row"), n, seed)
    return numbered.withColumn("__q", q).select(
        *df.columns,
        F.pmod("__q", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"__q div {shards}").alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs`` (doc_id, text)."""
    bytes_ = F.encode(base.text_of(docs), "UTF-8")
    rows = docs.select(
        "doc_id",
        (F.octet_length(bytes_) + 1).cast("long").alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
        F.xxhash64("text").alias("__hash"),
    )
    return shard_rows(rows, ["doc_id", "size", "text_crc32", "__hash"], shards, seed).drop("__hash")


def op12_feistel_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in 8 shards by the law ``rows``."""
    docs = base.table(spark, sf_dir, "documents").select(*ROW)
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
