"""Tables kept up by adding: rows of one key may stand in several runs until they are folded.

Rows go to hash buckets by their key. A batch adds one run to each bucket it touches and reads
nothing. Where a bucket has several runs of like size they are folded into one, so a row is rewritten
a number of times that grows with the logarithm of the table, and the files of other buckets stay. A
read combines only the buckets that hold more than one run.
"""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.snapshots import SnapshotTable, folder_of, partition_of

BUCKET = "__bucket"
EXPIRE_EVERY = 20  # versions


class RunTable:
    """Keyed rows in buckets and runs. Subclasses say in ``combine`` how rows of one key become one.

    Combining has to give the same whatever rows are combined first. ``fan`` runs of a bucket whose sizes
    are within that factor are folded; 0 never folds. Every twenty versions, files that only versions older
    than ``retain`` name are removed; None keeps all.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], buckets: int = 8, fan: int = 4, retain: timedelta | None = timedelta(days=7)):
        if fan == 1:
            raise ValueError("a run cannot be folded with itself: fan has to be 0 or at least 2")
        self.spark, self.table, self.keys = spark, SnapshotTable(spark, root), list(keys)
        self.buckets, self.fan, self.retain = buckets, fan, retain

    def combine(self, rows: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def add(self, rows: DataFrame, tag: str | None = None) -> None:
        """Add a batch that is combined already; a tag is applied once only."""
        if tag is not None and self.table.has_tag(tag):
            return
        if self.table.exists():
            before = self.table.append(self._placed(rows), tag=tag) - 1
        else:
            before = self.table.create(self._placed(rows), partition_by=[BUCKET], tag=tag)
        if self.fan:
            self.fold()
        if self.retain is not None and before // EXPIRE_EVERY < self.table.version() // EXPIRE_EVERY:
            self.table.expire(keep_versions=2, retain=self.retain, dry_run=False, force=True)

    def runs(self) -> dict[str, list[list[dict]]]:
        """The runs of each bucket: the files that one write left there."""
        found: dict[str, dict[str, list[dict]]] = {}
        for part in self.table.parts():
            found.setdefault(partition_of(part), {}).setdefault(part["root"] + "/" + folder_of(part), []).append(part)
        return {bucket: list(by_folder.values()) for bucket, by_folder in found.items()}

    def _due(self) -> list[dict]:
        due = []
        for runs in self.runs().values():
            tiers: dict[int, list[list[dict]]] = {}
            for run in runs:
                tiers.setdefault(int(math.log(sum(p["rows"] for p in run), self.fan)), []).append(run)
            due += [p for alike in tiers.values() if len(alike) >= self.fan for run in alike for p in run]
        return due

    def fold(self, everything: bool = False) -> None:
        """Fold runs of like size, or all runs of every bucket that has several."""
        due = [p for runs in self.runs().values() if len(runs) > 1 for run in runs for p in run] if everything else self._due()
        if not due:
            return
        self.table.replace_parts(due, self._placed(self.combine(self.table.read_parts(due).drop(BUCKET))), "FOLD")

    def rows(self) -> DataFrame:
        """One row for each key. Buckets with one run are only read."""
        alone, several = [], []
        for runs in self.runs().values():
            (alone if len(runs) == 1 else several).extend(p for run in runs for p in run)
        whole = self.table.read_parts(alone).drop(BUCKET)
        return whole.unionByName(self.combine(self.table.read_parts(several).drop(BUCKET))) if several else whole

    def add_stream(self, stream: DataFrame, checkpoint: str, add) -> None:
        """Call ``add(batch, tag)`` for all batches there are now; the tag tells a batch that comes again."""
        query = (
            stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(lambda batch, number: add(batch, f"{checkpoint}:{number}")).start()
        )
        query.awaitTermination()
