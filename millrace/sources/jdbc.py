"""Tables in other databases. Filters and column choices reach the database by themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    """One connection; for tables small enough for one task."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {})).load()


def read_partitioned(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Parallel connections, one per stride of a numeric column.

    The bounds only set the strides: rows outside them go to the first and last partition.
    """
    if partitions < 1 or upper <= lower:
        raise ValueError("need at least one partition and lower < upper")
    return spark.read.jdbc(
        url=url, table=table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=properties or {},
    )


def register_table(spark: SparkSession, name: str, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Make a remote table readable by name; its rows stay where they are."""
    read_table(spark, url, table, properties).createOrReplaceTempView(name)
