"""Change feeds: keep the latest state of each key, whatever order the changes arrive in."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.streaming.runs import RunTable

SEQUENCE, DELETED = "__sequence", "__deleted"


def _expr(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def latest_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The change with the largest sequence per key, deletions included.

    ``max_by`` is combined before the shuffle, so a key with very many changes is no hot spot.
    """
    rest = [c for c in changes.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.col(SEQUENCE)).alias("r")
    return changes.groupBy(*keys).agg(best).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


class ChangeTable(RunTable):
    """Latest row per key of a change feed.

    Applying a batch reduces it to one row per key and adds that as a run; the old rows are not read.
    ``compact_every`` runs of like size in a bucket are folded to one row per key, so reading reduces
    only what is not folded yet. Deletions stay as tombstones with their sequence, so that an older
    change that arrives late cannot bring a key back. Applying the same changes again changes
    nothing. Sequences of one key should not tie; make them a struct with a second column if they may.
    """

    def __init__(
        self, spark: SparkSession, root: str, keys: list[str], sequence_by: Column | str, delete_when: Column | str | None = None,
        except_columns: list[str] | None = None, compact_every: int = 4, buckets: int = 8, retain: timedelta | None = timedelta(days=7),
    ):
        super().__init__(spark, root, keys, buckets, compact_every, retain)
        self.sequence_by, self.delete_when, self.except_columns = sequence_by, delete_when, list(except_columns or [])

    def combine(self, rows: DataFrame) -> DataFrame:
        return latest_changes(rows, self.keys)

    def _reduced(self, batch: DataFrame) -> DataFrame:
        deleted = F.lit(False) if self.delete_when is None else F.coalesce(_expr(self.delete_when), F.lit(False))
        marked = batch.select(
            *[c for c in batch.columns if c not in self.except_columns],
            _expr(self.sequence_by).alias(SEQUENCE), deleted.alias(DELETED),
        ).filter(F.col(SEQUENCE).isNotNull())
        return self.combine(marked)

    def apply(self, batch: DataFrame, tag: str | None = None) -> None:
        self.add(self._reduced(batch), tag)

    def apply_stream(self, stream: DataFrame, checkpoint: str) -> None:
        """Apply all changes that are there now."""
        self.add_stream(stream, checkpoint, self.apply)

    def current(self) -> DataFrame:
        """Live rows, without the bookkeeping columns."""
        return self.rows().filter(~F.col(DELETED)).drop(SEQUENCE, DELETED)

    def tombstones(self) -> DataFrame:
        return self.rows().filter(F.col(DELETED)).select(*self.keys, SEQUENCE)

    def compact(self) -> None:
        self.fold(everything=True)
