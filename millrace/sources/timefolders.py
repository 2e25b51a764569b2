"""Files kept in yyyy/MM/dd/HH/mm folders."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import storage
from millrace.functions.times import folder_time


def _level(name: str, first: int, last: int) -> str:
    """Glob for one folder level: padded or bare numbers, with or without ``name=``."""
    numbers = sorted({text for n in range(first, last + 1) for text in (str(n), f"{n:02d}")})
    return "{" + ",".join([*numbers, *[f"{name}={n}" for n in numbers]]) + "}"


def _glob(root: str, names: tuple[str, ...], start: datetime, end: datetime) -> str:
    """The narrowest single glob that covers the interval: levels below the first that differs stay open."""
    levels = []
    for name, low, high in zip(names, start.timetuple()[:5], end.timetuple()[:5]):
        levels.append(_level(name, low, high))
        if low != high:
            break
    return "/".join([root.rstrip("/"), *levels, *["*"] * (5 - len(levels))])


def read_time_range(
    spark: SparkSession, root: str, start: datetime, end: datetime, file_type: str = "parquet", schema=None,
    names: tuple[str, ...] = ("y", "mo", "d", "h", "mi"), options: dict[str, str] | None = None,
) -> DataFrame:
    """Rows of the files whose folder time is in [start, end), at minute grain.

    A glob keeps the listing to the folders around the interval; the exact test then runs on
    the file path that every row carries.
    """
    start, end = start.replace(second=0, microsecond=0), end.replace(second=0, microsecond=0)
    if end <= start:
        raise ValueError("start has to be before end")
    reader = spark.read.format(file_type).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.option("basePath", root).load(_glob(root, names, start, end))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND" and schema is not None:
            return spark.createDataFrame([], schema)  # no folder anywhere near the interval
        raise
    when = folder_time("_metadata.file_path")
    df = df.filter((when >= F.lit(start).cast("timestamp_ntz")) & (when < F.lit(end).cast("timestamp_ntz")))
    # Columns that folders named name=value add; a data column of such a name stays where folders are bare numbers.
    in_path = [n for n in names if n in df.columns and _named(spark, root, names, n)]
    return df.drop(*in_path)


def _named(spark: SparkSession, root: str, names: tuple[str, ...], name: str) -> bool:
    """Whether the folders of this level are called name=value."""
    pattern = "/".join([root.rstrip("/"), *["*"] * names.index(name), f"{name}=*"])
    return storage.any_match(spark, pattern)


def latest_folder_time(spark: SparkSession, root: str) -> DataFrame:
    """One row: the newest folder time below a root.

    Five listings, one a level: the folder with the largest number leads on. Folder 10 comes after
    folder 9. A folder without a complete path of folders and a file in it does not count.
    """
    return spark.range(1).select(folder_time(F.lit(_latest(spark, root.rstrip("/"), 5) or "")).alias("latest"))


def _latest(spark: SparkSession, path: str, levels: int) -> str | None:
    names = storage.file_names(spark, path)
    if not levels:
        files = [n for n in names if not n.startswith(("_", "."))]
        return f"{path}/{files[0]}" if files else None
    numbers = {n: int(m[1]) for n in names if (m := re.fullmatch(r"(?:\w+=)?(\d+)", n))}
    found = (_latest(spark, f"{path}/{n}", levels - 1) for n in sorted(numbers, key=numbers.get, reverse=True))
    return next((f for f in found if f), None)
