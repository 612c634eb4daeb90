"""Projection helper for expensive expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_once(df: DataFrame, *columns: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """``select`` whose expressions are evaluated once per row.

    Catalyst moves a filter below a projection by copying the projected
    expressions into it, so parsing followed by filters on the parsed fields
    would parse a line again for every condition. Filters on a generator's
    output stay above it; a one-element ``inline`` is such a generator.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))
