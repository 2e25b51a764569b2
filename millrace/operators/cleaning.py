"""Deduplication and uniqueness checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the number of NULLs of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def collapse(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per key with the largest non-NULL value of each column; NULL keys are dropped.

    ``max`` is combined before the shuffle, so copies of one key never meet in one task.
    """
    return df.na.drop(subset=keys[:1]).groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])


def is_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row, one boolean: does no key occur twice?"""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg((F.max("n") <= 1).alias("no_duplicates"))


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is largest in ``order``; for a whole result ``order`` has to be free of ties."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])
