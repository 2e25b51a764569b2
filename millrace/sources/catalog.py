"""Named tables, views and schemas of the session catalog, and what is known about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _options(options: dict[str, str]) -> str:
    return ", ".join("'{}' = '{}'".format(k, v.replace("'", "\\'")) for k, v in options.items())


def external_table(spark: SparkSession, name: str, columns: str, file_type: str, path: str, options: dict[str, str] | None = None) -> None:
    """Declare schema and options once; the files stay where they are."""
    clause = f" OPTIONS ({_options(options)})" if options else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {file_type}{clause} LOCATION '{path}'")


def view_over_files(spark: SparkSession, name: str, file_type: str, path: str, options: dict[str, str] | None = None) -> None:
    options = {"path": path, **(options or {})}
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING {file_type} OPTIONS ({_options(options)})")


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and number of values, counted in one pass."""
    counts = df.agg(*[F.count(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"c{i}").alias("values"))
        for i, f in enumerate(df.schema.fields)
    ])
    return counts.select(F.inline(rows))


def file_details(df: DataFrame) -> DataFrame:
    """Number of files and of bytes a file-based frame reads; the files are listed, not read."""
    sizes = df.sparkSession.read.format("binaryFile").load(df.inputFiles())
    return sizes.agg(F.count(F.lit(1)).alias("num_files"), F.sum("length").alias("size_in_bytes"))


def rows_per_file(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("_metadata.file_path").alias("source_file")).count()
