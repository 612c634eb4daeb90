"""What must not grow: repeated rows, one id of many rows, and stages that keep clean documents."""

import random

from pyspark.sql import functions as F

from tests.llm.common import documents, tables
from tests.llm.test_tables import by_sql, rows_of
from tripflow.llm import decontaminate, language_id, quality, topk


def test_repeated_rows_leave_no_more_candidates(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(k, [rnd.gauss(0, 1) for _ in range(16)]) for k in range(400)]
    kept, keep = [], topk.base.keep
    monkeypatch.setattr(topk.base, "keep", lambda df: kept.append(keep(df)) or kept[-1])
    schema = "vec_id long, embedding array<double>"
    counts = []
    for times in (1, 20):
        df = spark.createDataFrame(rows * times, schema).repartition(5)
        kept.clear()
        got = topk.top_k(df, df.where("vec_id % 50 = 0"))
        assert rows_of(got) == by_sql(topk.ORACLE, embeddings=spark.createDataFrame(rows, schema))
        counts.append(sum(k.count() for k in kept))
    assert counts[0] == counts[1] < 0.5 * 8 * 399


def test_rows_of_one_id_with_different_vectors(spark):
    rnd = random.Random(8)
    rows = [(rnd.randrange(60), [round(rnd.gauss(0, 1), 1) for _ in range(5)]) for _ in range(700)]
    seen, own = set(), []
    for i, v in rows:  # queries are one vector each
        if i % 50 or i not in seen:
            own.append((i, v))
        seen.add(i)
    df = spark.createDataFrame(own, "vec_id long, embedding array<double>").repartition(4)
    assert rows_of(topk.top_k(df, df.where("vec_id % 50 = 0"))) == by_sql(topk.ORACLE, embeddings=df)


def test_one_id_of_many_rows_sends_one_bag(spark, monkeypatch):
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("some text "), F.col("id")).alias("text"))
    docs = docs.unionByName(spark.range(100, 130).select(F.col("id").alias("doc_id"), F.lit("other words").alias("text")))
    labels = spark.createDataFrame([(7, 1), (7, 1), (7, 0)] + [(k, 0) for k in range(100, 130)], "doc_id long, label int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda bags, share, *a, **k: seen.append(len(bags)) or quality.Model(quality.np.zeros(quality.BUCKETS), 0.0))
    quality.fit(docs, labels)
    assert seen and seen[0] <= 2 + 30


def test_windows_of_items_without_id_are_hit(spark, tmp_path):
    window = "one two three four five six seven eight nine ten"
    docs = documents(spark, [(1, f"a {window} b"), (2, "short item here"), (3, "nothing")])
    items = spark.createDataFrame([(None, window), (None, window), ("x", "short item"), ("x", "short item")], "item_id string, text string")
    sf = tables(spark, tmp_path, documents=docs, benchmark=items)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.op4_decontaminate_prefix_join(spark, sf).collect()}
    assert got == {1: (12, 10, 0, True), 2: (3, 2, 1, True), 3: (1, 0, 0, False)}


def test_language_stage_without_known_languages(spark):
    rows = [(k, t, None) for k, t in enumerate(["some words", "12 34", "", None, "слова", "!"])]
    docs = documents(spark, rows)
    assert sorted(r.doc_id for r in language_id.language_stage(spark, docs, "").collect()) == [0, 4]
