"""The user-defined function forms. Built-in expressions are faster; these are the extension points.

The functions are made inside factories, so that they travel to the executors by value and
the package need not be installed there.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def first_letter_rowwise():
    """Plain Python, one value at a time, exchanged in Arrow batches."""

    def first_letter(value):
        return None if value is None else value[:1]

    return F.udf(first_letter, "string", useArrow=True)


def first_letter_vectorised():
    """A whole Arrow batch at a time as a pandas Series."""

    def first_letter(values: pd.Series) -> pd.Series:
        return values.str[:1]

    return F.pandas_udf(first_letter, "string")


def register_first_letter(spark: SparkSession, name: str = "first_letter") -> None:
    spark.udf.register(name, first_letter_rowwise())


def define_sql_function(spark: SparkSession, name: str, arguments: str, returns: str, body: str) -> None:
    """A scalar SQL function; the optimiser inlines its body, so it costs nothing per call."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {returns} RETURN {body}")
