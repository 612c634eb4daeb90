"""Small documents for the tests of this folder."""

from __future__ import annotations

import re

from tripflow.llm import base

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """documents from (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def tables(spark, tmp_path, **frames):
    """A folder of Parquet tables."""
    for name, df in frames.items():
        df.write.parquet(f"file://{tmp_path}/{name}.parquet")
    return f"file://{tmp_path}"


def clashing(df):
    """The table with further columns named like results."""
    from pyspark.sql import functions as F

    names = ["n_words", "score", "digest", "n", "id", "leaf", "s", "first", "line", "a", "h", "spans", "component_id"]
    return df.withColumns({c: F.lit("x") for c in names if c not in df.columns})


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


OUT = base.OUT
