"""Intermediate tables in the folder that all executors see."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where that is unset, a session with a local master takes the warehouse folder.
    On a cluster that folder may be each machine's own, so there the setting is needed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tripflow-{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage is cut, lost executors cost nothing."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
