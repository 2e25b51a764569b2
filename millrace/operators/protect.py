"""Column redaction and row filters that depend on who asks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import mask_tail


def groups_of(entitlements: DataFrame, user: str) -> set[str]:
    """Groups one user belongs to, from a table with columns user_name and group_name."""
    rows = entitlements.filter(F.col("user_name") == user).select("group_name").distinct().collect()
    return {r["group_name"] for r in rows}


def _flag(member: Column | bool) -> Column:
    return F.lit(member) if isinstance(member, bool) else member


def redact(df: DataFrame, columns: list[str], restricted: Column | bool, label: str = "REDACTED") -> DataFrame:
    """Show ``label`` instead of the columns' values to restricted readers."""
    return df.withColumns({c: F.when(_flag(restricted), F.lit(label)).otherwise(F.col(c).cast("string")) for c in columns})


def mask_columns(df: DataFrame, columns: list[str], keep: int = 2) -> DataFrame:
    return df.withColumns({c: mask_tail(c, keep) for c in columns})


def filter_rows(df: DataFrame, restricted: Column | bool, allowed: Column | str) -> DataFrame:
    """Restricted readers see only the allowed rows; others see all."""
    allowed = F.expr(allowed) if isinstance(allowed, str) else allowed
    return df.filter(F.when(_flag(restricted), allowed).otherwise(F.lit(True)))
