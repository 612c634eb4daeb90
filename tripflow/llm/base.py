"""What the operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tripflow.functions.shared import keep  # noqa: F401  (used by the operators as base.keep)

#: Name of the struct column that row operators add; input columns of this name are not allowed.
OUT = "__llm_out"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def struct_of(ddl: str) -> T.StructType:
    """The type that ``ddl``, struct<...>, names."""
    return T.DataType.fromDDL(ddl)


def give_back() -> None:
    """Memory that a batch has needed goes back to the system before the next one, as workers are used again."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of most Linux systems has it
    if trim:
        trim(0)


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(df[column], F.lit(""))


def with_rows(
    df: DataFrame, make: Callable[[], Callable[..., list]], schema: T.StructType, *columns: Column
) -> DataFrame:
    """``df`` with a struct column OUT, made row by row from Arrow batches of ``columns``.

    ``make`` runs once per task and returns a function from Python lists (one per
    column) to a list of tuples. Other columns of ``df`` do not cross to Python.
    """
    kind = to_arrow_type(schema)
    names = [f.name for f in kind]

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            parts = batch if isinstance(batch, tuple) else (batch,)
            rows = work(*(x.to_pylist() for x in parts))
            held = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            arrays = [pa.array(list(v), f.type) for v, f in zip(held, kind, strict=True)]
            yield pa.StructArray.from_arrays(arrays, fields=list(kind))
            del parts, rows, held, arrays
            give_back()

    def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return run(batches)

    def many(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return run(batches)

    # the annotations decide the kind of UDF; postponed annotations are strings, so they are set here
    one.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    many.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(one if len(columns) == 1 else many, schema)
    return df.withColumn(OUT, udf(*columns))


def map_texts(
    df: DataFrame, work: Callable[[Iterator[list[list]]], Iterator[list[tuple]]], schema: T.StructType
) -> DataFrame:
    """``mapInArrow`` over Python lists: batches of columns in, lists of row tuples out."""
    kind = pa.schema(list(to_arrow_type(schema)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in work([c.to_pylist() for c in b.columns] for b in batches):
            if rows:
                held = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(v), f.type) for v, f in zip(held, kind, strict=True)], schema=kind
                )
                del rows, held
                give_back()

    return df.mapInArrow(run, schema)
