"""Shards by a Feistel permutation."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.common import clashing, documents
from tripflow.llm import sharding

SMALL = "/root/testdata/sf0.001"


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 1 << 40))
def test_permutation(n, seed):
    p = sharding.Feistel(n, seed)
    x = np.arange(n)
    y = p.of(x)
    assert sorted(y.tolist()) == list(range(n))
    assert p.inverse(y).tolist() == x.tolist()


def test_permutation_of_a_wide_range():
    p = sharding.Feistel(10**15 + 37)
    x = np.random.default_rng(1).integers(0, 10**15, 5000)
    y = p.of(x)
    assert p.inverse(y).tolist() == x.tolist() and int(y.max()) < 10**15 + 37
    assert abs(np.corrcoef(x.astype(float), y.astype(float))[0, 1]) < 0.05
    with pytest.raises(ValueError):
        p.of(np.array([10**15 + 37]))


def laws(rows, data, shards=8):
    """Counts at most one apart, slots without gaps, sizes and checksums right."""
    want = sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in data), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=repr) == want
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    sizes = [len(by_shard.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(data)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())


def test_query(spark):
    df = sharding.op12_feistel_shards(spark, SMALL)
    data = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = df.collect()
    laws(rows, data)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    assert dict(df.dtypes)["size"] == dict(df.dtypes)["slot"] == "bigint" and dict(df.dtypes)["shard"] == "int"


def test_layout_does_not_matter_and_places_can_be_computed(spark):
    rnd = random.Random(5)
    data = [(i // 2, f"text {rnd.random()}") for i in range(700)]
    first = sharding.shard_documents(documents(spark, data)).collect()
    rnd.shuffle(data)
    again = sharding.shard_documents(documents(spark, data).repartition(13)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    # the row number at a place follows from the place alone
    at = {(r.shard, r.slot): r for r in first}
    keys = {}
    for (shard, slot), r in at.items():
        keys[sharding.row_of(shard, slot, len(data))] = r.doc_id
    assert [keys[i] for i in range(700)] == sorted(d for d, _ in data)
    other = sharding.shard_documents(documents(spark, data), seed=7).collect()
    assert sorted(map(tuple, first)) != sorted(map(tuple, other))


def test_edge_rows(spark):
    data = [(None, None), (None, "a"), (1, None), (1, ""), (2, "ü\n"), *[(3, "copy")] * 400, (4, "x" * 200_000)]
    laws(sharding.shard_documents(clashing(documents(spark, data))).collect(), data)
    assert sharding.shard_documents(documents(spark, [])).collect() == []
    laws(sharding.shard_documents(documents(spark, [(9, "one")])).collect(), [(9, "one")])


def test_copies_of_one_row_are_split(spark, tmp_path):
    from pyspark.sql import functions as F

    path = f"file://{tmp_path}/d.parquet"
    spark.range(0, 30_000, 1, 4).select(F.lit(5).cast("long").alias("doc_id"), F.lit("same").alias("text")).write.parquet(path)
    rows = sharding.shard_documents(spark.read.parquet(path)).collect()
    laws(rows, [(5, "same")] * 30_000)
