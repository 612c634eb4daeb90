"""Global row numbers."""

import random

from pyspark.sql import functions as F

from tripflow.functions.numbering import number_rows


def test_numbers_follow_the_order(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t int, i int").repartition(7)
    got = {r.i: r.n for r in number_rows(df, ["k", "t", "i"], "n").collect()}
    want = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1], r[2]))
    assert [got[r[2]] for r in want] == list(range(3000))


def test_a_key_of_many_rows_is_split(spark):
    df = spark.range(0, 20_000, 1, 4).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    got = number_rows(df, ["k", "id"], "n", 8)
    assert sorted(r.n for r in got.select("n").collect()) == list(range(20_000))


def test_empty(spark):
    assert number_rows(spark.range(0), ["id"]).collect() == []
