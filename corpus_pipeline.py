"""A training corpus from raw documents, in five stages.

Each stage takes what its predecessor kept, works on all of it, and returns the
columns of ``documents``; the last returns ids and digests. A stage's result is
written to the shared folder and read again, so a lost executor costs one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.llm import base
from tripflow.llm.byte_bpe import code_stage
from tripflow.llm.decontaminate import decontaminate_stage
from tripflow.llm.language_id import language_stage
from tripflow.llm.line_dedup import line_stage
from tripflow.llm.ngram_join import join_stage

STAGES = [
    ("language", language_stage),
    ("lines", line_stage),
    ("near duplicates", join_stage),
    ("benchmark", decontaminate_stage),
    ("tokens", code_stage),
]

#: SQL cannot express the stages; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = base.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = base.keep(stage(spark, docs, sf_dir))
    return docs
