"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_sum(value: Column | str, places: int = 2) -> Column:
    """Sum of doubles, the result rounded: its last digits depend on the order in which tasks add.

    Values of any size and NaN keep their meaning.
    """
    return _rounded(F.sum(value), places)


def rounded_avg(value: Column | str, places: int = 4) -> Column:
    return _rounded(F.avg(value), places)


def _rounded(total: Column, places: int) -> Column:
    finite = F.abs(total) < float("inf")
    return F.when(finite, F.round(total, places)).otherwise(total)


def cut_decimals(value: Column | str, places: int = 2) -> Column:
    """Drop, not round, the digits after ``places``."""
    value = F.col(value) if isinstance(value, str) else value
    factor = 10**places
    return (value * factor).cast("long") / factor


def net_price() -> Column:
    """Line revenue after discount."""
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))
