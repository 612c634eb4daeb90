"""Numbers of rows in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.shared import keep

#: Bits of ``monotonically_increasing_id`` that count rows inside a partition.
PLACE_BITS = 33
PART, PLACE = "__part", "__place"


def ordered_parts(df: DataFrame, order: list[Column | str], num_partitions: int | None = None) -> DataFrame:
    """``df`` in range partitions, sorted, written out; with each row's part and place from 0 in it.

    A part's rows come before all rows of the parts with higher numbers. A range
    partitioning samples its input first, so ``df`` is computed twice unless it
    reads files or a shuffle.
    """
    parts = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    marked = parts.sortWithinPartitions(*order).withColumn(PLACE, F.monotonically_increasing_id())
    return keep(marked.select(
        *df.columns,
        F.shiftright(PLACE, PLACE_BITS).cast("int").alias(PART),
        F.col(PLACE).bitwiseAND((1 << PLACE_BITS) - 1).alias(PLACE),
    ))


def part_offsets(parts: DataFrame) -> DataFrame:
    """(part, ``__before``): rows of earlier parts. One row for each range partition."""
    counts = parts.groupBy(PART).agg(F.count("*").alias("n")).collect()  # one row a partition
    rows, before = [], 0
    for r in sorted(counts, key=lambda r: r[PART]):
        rows.append((r[PART], before))
        before += r["n"]
    return parts.sparkSession.createDataFrame(rows, f"{PART} int, __before bigint")


def number_rows(
    df: DataFrame, order: list[Column | str], name: str = "row_number", num_partitions: int | None = None
) -> DataFrame:
    """Add ``name``: the row's place from 0 in the global order of ``order``.

    The place comes from the ordered rows themselves: range partitions, the count
    of each, and the place inside the partition. No row passes through a single
    task, and a key that holds many rows is split as far as ``order`` tells its rows apart.
    """
    parts = ordered_parts(df, order, num_partitions)
    return parts.join(F.broadcast(part_offsets(parts)), PART).select(
        *df.columns, (F.col("__before") + F.col(PLACE)).alias(name)
    )
