"""Session settings and the shared folder for files a job has to write on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.storage import delete

_own_folder: str | None = None


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.metricsEnabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "7g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder that all executors share.

    The folder is the session's ``spark.checkpoint.dir``. Only a local session may do
    without it: its executors live on this machine, so a temporary folder is shared too.
    """
    global _own_folder
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        if _own_folder is None:
            _own_folder = tempfile.mkdtemp(prefix="millrace-")
        base = _own_folder
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Whether a query's shuffle files go as soon as it has ended, rather than when the driver happens to collect its garbage.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Steps:
    """Frames written to the shared folder on the way; with them, their files go at the end of the ``with`` block.

    What is read after the block has to be written by other steps, or outside of any block.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def __enter__(self) -> Steps:
        return self

    def __exit__(self, *failure: object) -> None:
        for path in self.paths:
            delete(self.spark, path)

    def written(self, df: DataFrame, label: str) -> DataFrame:
        """The frame, read again from its files; those of its shuffles are gone."""
        conf, path = self.spark.conf, scratch(self.spark, label)
        self.paths.append(path)
        before = conf.get(_SHUFFLES_GO, None)
        conf.set(_SHUFFLES_GO, "true")
        try:
            df.write.parquet(path)
        finally:
            conf.unset(_SHUFFLES_GO) if before is None else conf.set(_SHUFFLES_GO, before)
        return self.spark.read.schema(df.schema).parquet(path)
