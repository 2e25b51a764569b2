"""Arrays of structs to one row per element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(documents: DataFrame, array: str, into: str = "item", keep_empty: bool = False) -> DataFrame:
    """One row per array element. Rows with no element vanish unless ``keep_empty``."""
    explode = F.explode_outer if keep_empty else F.explode
    return documents.withColumn(into, explode(array)).drop(*([] if into == array else [array]))
