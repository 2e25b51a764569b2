"""Folder-level file-system calls, through the Hadoop client Spark itself uses.

They see folders, file sizes and small text files, never rows, and work on any store Spark can
write to.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def file_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _open(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, such as one history row."""
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file."""
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        reader = spark._jvm.java.io.InputStreamReader(stream, "UTF-8")
        line = spark._jvm.java.io.BufferedReader(reader).readLine()
        return line.removeprefix("\ufeff") if line is not None else None
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet: the store lets one writer create it, and refuses others."""
    fs, hadoop_path = _open(spark, path)
    try:
        stream = fs.create(hadoop_path, False)
    except Py4JJavaError as error:
        if fs.exists(hadoop_path):
            raise FileExistsError(path) from error
        raise
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.delete(hadoop_path, True)


def raw_path(spark: SparkSession, path: str) -> str:
    """The URL-encoded path without scheme and host, as it ends ``_metadata.file_path``."""
    fs, hadoop_path = _open(spark, path)
    return fs.makeQualified(hadoop_path).toUri().getRawPath()


def usage(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number of files and of bytes below a folder."""
    fs, hadoop_path = _open(spark, path)
    summary = fs.getContentSummary(hadoop_path)
    return summary.getFileCount(), summary.getLength()


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether a glob matches something."""
    fs, hadoop_path = _open(spark, pattern)
    return len(fs.globStatus(hadoop_path) or []) > 0
