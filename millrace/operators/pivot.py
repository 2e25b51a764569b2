"""Pivot with listed values in one shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_listed(
    df: DataFrame, keys: list[str], column: str, values: list[str], aggregate: Callable[[Column], Column], value: Column | str
) -> DataFrame:
    """One column per listed value of ``column``, each the aggregate of ``value`` over its rows.

    ``groupBy().pivot()`` shuffles twice: by keys and value, then by keys. Here each column is
    an aggregate over the rows of its value, combined before a single shuffle. An aggregate that
    ignores NULLs, such as sum, gives NULL for an empty cell, as the pivot does.
    """
    value = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(*[aggregate(F.when(F.col(column) == v, value)).alias(v.lower()) for v in values])
