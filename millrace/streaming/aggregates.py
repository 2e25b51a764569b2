"""Aggregates kept in a table as states that can be merged."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import storage
from millrace.operators.snapshots import SnapshotTable
from millrace.session import scratch
from millrace.streaming.runs import BUCKET, RunTable

COUNT, SUM, MIN, MAX, AVG, DISTINCT = "count", "sum", "min", "max", "avg", "approximate distinct"


@dataclass(frozen=True)
class Aggregate:
    """``kind`` of ``value`` (a column or SQL expression; for a count, rows where it is not null; all rows without it)."""

    kind: str
    value: Column | str | None = None

    def __post_init__(self):
        if self.kind not in (COUNT, SUM, MIN, MAX, AVG, DISTINCT):
            raise ValueError(f"no aggregate of kind {self.kind}")
        if self.value is None and self.kind != COUNT:
            raise ValueError(f"{self.kind} needs a value")

    def _value(self) -> Column:
        return F.lit(1) if self.value is None else F.expr(self.value) if isinstance(self.value, str) else self.value

    def states(self) -> dict[str, Column]:
        """The parts of the state, from rows."""
        v = self._value()
        if self.kind == AVG:
            return {"sum": F.sum(v), "count": F.count(v)}
        if self.kind == SUM:
            return {"sum": F.sum(v), "count": F.count(v)}  # without values a sum is null
        if self.kind == DISTINCT:
            return {"sketch": F.hll_sketch_agg(v, F.lit(14))}
        return {self.kind: {COUNT: F.count, MIN: F.min, MAX: F.max}[self.kind](v)}

    @staticmethod
    def merged(part: str, column: Column) -> Column:
        return {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "sketch": lambda c: F.hll_union_agg(c)}[part](column)

    def result(self, name: str) -> Column:
        """The value from the columns of the state."""
        part = lambda p: F.col(_column(name, p))
        if self.kind == AVG:
            return F.when(part("count") > 0, part("sum") / part("count"))
        if self.kind == SUM:
            return F.when(part("count") > 0, part("sum"))
        if self.kind == DISTINCT:
            return F.hll_sketch_estimate(part("sketch"))
        return part(self.kind)


def _column(name: str, part: str) -> str:
    return f"{name}__{part}"


def partial(rows: DataFrame, keys: list[str], aggregates: dict[str, Aggregate]) -> DataFrame:
    """One row of states per group."""
    return rows.groupBy(*keys).agg(*[c.alias(_column(n, p)) for n, a in aggregates.items() for p, c in a.states().items()])


def combined(states: DataFrame, keys: list[str], aggregates: dict[str, Aggregate]) -> DataFrame:
    """States of one group merged."""
    return states.groupBy(*keys).agg(*[a.merged(p, F.col(_column(n, p))).alias(_column(n, p)) for n, a in aggregates.items() for p in a.states()])


def finished(states: DataFrame, keys: list[str], aggregates: dict[str, Aggregate]) -> DataFrame:
    return states.select(*keys, *[a.result(n).alias(n) for n, a in aggregates.items()])


class AggregateTable(RunTable):
    """Aggregates per group over all rows so far.

    A batch is reduced to one state per group, and these are added as a run: nothing that is stored is
    read, and no state is held between batches. Runs of like size are folded bucket by bucket. Equal
    to the aggregate over all rows; sums and means of doubles up to rounding.
    """

    def __init__(
        self, spark: SparkSession, root: str, keys: list[str], aggregates: dict[str, Aggregate], buckets: int = 8, fan: int = 4,
        retain: timedelta | None = timedelta(days=7),
    ):
        super().__init__(spark, root, keys, buckets, fan, retain)
        self.aggregates = dict(aggregates)

    def combine(self, rows: DataFrame) -> DataFrame:
        return combined(rows, self.keys, self.aggregates)

    def apply(self, batch: DataFrame, tag: str | None = None) -> None:
        self.add(partial(batch, self.keys, self.aggregates), tag)

    def apply_stream(self, stream: DataFrame, checkpoint: str) -> None:
        """Add all input that is there now."""
        self.add_stream(stream, checkpoint, self.apply)

    def current(self) -> DataFrame:
        return finished(self.rows(), self.keys, self.aggregates)

    def by(self, *keys: Column | str, where: Column | str | None = None) -> DataFrame:
        """The aggregates by coarser keys, over groups that meet a condition, from the stored states alone."""
        chosen = self.rows() if where is None else self.rows().filter(where)
        states = combined(chosen, list(keys), self.aggregates)
        return finished(states, states.columns[: len(keys)], self.aggregates)


class MaintainedAggregate:
    """An aggregate over a versioned table, kept up by what changed in it.

    A refresh reads only files that one of the two versions has and the other has not. Counts and sums
    change by the difference of added and removed rows. A smallest or largest value that was removed
    and not added again is found anew, from the source's rows of those groups alone; so are sums of
    groups that a changed sum has left with infinities or NaN, and distinct counts that lost rows. Only
    buckets of changed groups are rewritten. The source version is committed with the result, so a
    refresh that is repeated does nothing.
    """

    SIZE = "__rows"

    def __init__(
        self, source: SnapshotTable, root: str, keys: list[str], aggregates: dict[str, Aggregate], where: Column | str | None = None, buckets: int = 8,
    ):
        self.source, self.spark, self.table = source, source.spark, SnapshotTable(source.spark, root)
        self.keys, self.where, self.buckets = list(keys), where, buckets
        self.aggregates = {**aggregates, self.SIZE: Aggregate(COUNT)}
        self.shown = list(aggregates)

    def _rows(self, parts: list[dict]) -> DataFrame:
        rows = self.source.read_parts(parts)
        return rows if self.where is None else rows.filter(self.where)

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def refreshed_to(self) -> int | None:
        """The source version that the result stands for."""
        return self.table._entry()["tags"]["source"] if self.table.exists() else None

    def changed_parts(self, since: int, now: int) -> tuple[list[dict], list[dict]]:
        """Files that the newer version has gained, and lost."""
        label = lambda p: (p["root"], p["path"])
        old, new = ({label(p): p for p in self.source.parts(v)} for v in (since, now))
        return [p for k, p in new.items() if k not in old], [p for k, p in old.items() if k not in new]

    def refresh(self) -> int:
        """Bring the result to the source's newest version; returns how many of the source's files were read for the difference."""
        now, since = self.source.version(), self.refreshed_to()
        if since is None:
            parts = self.source.parts(now)
            states = partial(self._rows(parts), self.keys, self.aggregates)
            self.table.create(self._placed(states), partition_by=[BUCKET], tag=f"source:{now}")
            return len(parts)
        if since == now:
            return 0
        gone = [p for p in self.changed_parts(since, now)[1] if not storage.exists(self.spark, f"{p['root']}/data/{p['path']}")]
        if gone:  # expired: no difference can be told any more
            parts = self.source.parts(now)
            self.table.overwrite(self._placed(partial(self._rows(parts), self.keys, self.aggregates)), tag=f"source:{now}")
            return len(parts)
        added, removed = self.changed_parts(since, now)
        if not added and not removed:
            self.table.append(self.table.read().limit(0), tag=f"source:{now}")
            return 0
        # Two sides of one union: rows in both, which a rewritten file carries along, cancel out.
        up = self._rows(added).select("*", F.lit(True).alias("__up")) if added else None
        down = self._rows(removed).select("*", F.lit(False).alias("__up")) if removed else None
        rows = up if down is None else down if up is None else up.unionByName(down)
        change = self._staged(self._placed(rows.groupBy(*self.keys).agg(*self._differences())), "change")
        touched = [r[0] for r in change.select(BUCKET).distinct().collect()]  # at most one for each bucket
        old_parts = [p for p in self.table.parts() if any(p["path"].split("/")[1] == f"{BUCKET}={b}" for b in touched)]
        merged = self._staged(self._merge(self.table.read_parts(old_parts), change), "merged")
        lost = merged.filter("__lost")
        known = merged.filter(f"NOT __lost AND {_column(self.SIZE, 'count')} > 0").drop("__lost")
        if not lost.isEmpty():
            groups = lost.select(*[F.col(k).alias(f"__{k}") for k in self.keys])
            same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys]
            fresh = partial(self._rows(self.source.parts(now)).join(groups, same, "left_semi"), self.keys, self.aggregates)
            known = known.unionByName(self._placed(fresh))
        self.table.replace_parts(old_parts, known, "REFRESH", tag=f"source:{now}")
        return len(added) + len(removed)

    def _staged(self, rows: DataFrame, name: str) -> DataFrame:
        path = scratch(self.spark, f"refresh-{name}")
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _differences(self) -> list[Column]:
        out = []
        for name, a in self.aggregates.items():
            v = a._value()
            gained, gone = F.when(F.col("__up"), v), F.when(~F.col("__up"), v)
            if a.kind in (COUNT, SUM, AVG):
                out.append((F.count(gained) - F.count(gone)).alias(_column(name, "count")))
            if a.kind in (SUM, AVG):
                zero = F.lit(0)
                out.append((F.coalesce(F.sum(gained), zero) - F.coalesce(F.sum(gone), zero)).alias(_column(name, "sum")))
            if a.kind in (MIN, MAX):
                best = F.min if a.kind == MIN else F.max
                out += [best(gained).alias(_column(name, a.kind)), best(gone).alias(_column(name, "gone"))]
            if a.kind == DISTINCT:
                out += [F.hll_sketch_agg(gained, F.lit(14)).alias(_column(name, "sketch")), F.count(gone).alias(_column(name, "gone"))]
        return out

    def _merge(self, old: DataFrame, change: DataFrame) -> DataFrame:
        """Old states with the difference, and whether a group has to be computed anew."""
        named = change.withColumnsRenamed({c: f"__new_{c}" for c in change.columns})
        same = [F.col(k).eqNullSafe(F.col(f"__new_{k}")) for k in [*self.keys, BUCKET]]
        both = old.join(named, same, "full_outer")
        columns = [F.coalesce(F.col(k), F.col(f"__new_{k}")).alias(k) for k in self.keys]
        lost = F.lit(False)
        size = _column(self.SIZE, "count")
        left = F.coalesce(F.col(size), F.lit(0)) + F.coalesce(F.col(f"__new_{size}"), F.lit(0)) > 0
        for name, a in self.aggregates.items():
            for part in a.states():
                was, new = F.col(_column(name, part)), F.col(f"__new_{_column(name, part)}")
                if part in ("count", "sum"):
                    value = F.coalesce(was, F.lit(0)) + F.coalesce(new, F.lit(0))
                    if part == "sum" and old.schema[_column(name, part)].dataType.typeName() in ("double", "float"):
                        # Infinities and NaN do not cancel out.
                        lost = lost | (F.isnan(value) | (F.abs(value) == float("inf"))) & new.isNotNull()
                elif part == "sketch":
                    value = F.when(was.isNull(), new).when(new.isNull(), was).otherwise(F.hll_union(was, new))
                    lost = lost | (F.coalesce(F.col(f"__new_{_column(name, 'gone')}"), F.lit(0)) > 0)
                else:
                    best, gone = (F.least if part == "min" else F.greatest)(was, new), F.col(f"__new_{_column(name, 'gone')}")
                    # The old extreme was among what went, and nothing as good came.
                    lost = lost | (gone.isNotNull() & was.isNotNull() & (gone == was) & ~F.coalesce(new == best, F.lit(False)))
                    value = best
                columns.append(value.cast(old.schema[_column(name, part)].dataType).alias(_column(name, part)))
        return both.select(*columns, F.coalesce(F.col(BUCKET), F.col(f"__new_{BUCKET}")).alias(BUCKET), (left & F.coalesce(lost, F.lit(False))).alias("__lost"))

    def read(self) -> DataFrame:
        return finished(self.table.read(), self.keys, {n: self.aggregates[n] for n in self.shown})
