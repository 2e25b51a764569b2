"""Upsert: combine target rows with a source of changes by key, under ordered clauses."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPDATE, DELETE, INSERT = "update", "delete", "insert"


@dataclass(frozen=True)
class Clause:
    """One WHEN branch. ``t.`` names target columns and ``s.`` source columns in expressions."""

    kind: str
    condition: Column | str | None = None
    values: dict[str, Column | str] | None = None


def when_matched_update(condition=None, set=None) -> Clause:
    """Without ``set``, every target column that the source has takes the source's value."""
    return Clause(UPDATE, condition, set)


def when_matched_delete(condition=None) -> Clause:
    return Clause(DELETE, condition)


def when_not_matched_insert(condition=None, values=None) -> Clause:
    """Without ``values``, every target column takes the source's value, or NULL if it has none."""
    return Clause(INSERT, condition, values)


class DuplicateSourceRows(ValueError):
    """Two source rows claim the same target row, so the result would depend on their order."""


def _as_column(value: Column | str | None) -> Column:
    if value is None:
        return F.lit(True)
    return F.expr(value) if isinstance(value, str) else value


MOST_SENT = 100_000  # rows of a source that may be broadcast; a small file can hold very many


def for_joins(source: DataFrame) -> DataFrame:
    """The source as joins should take it: Spark may broadcast a small one, a large one is shuffled.

    Spark's own check goes by the size of files, and rows of few bytes take many times as much on the driver.
    """
    return source.hint("merge") if source.limit(MOST_SENT + 1).count() > MOST_SENT else source


def _same_key(left: str, right: str, keys: list[str], null_safe: bool) -> Column:
    def same(k: str) -> Column:
        a, b = F.col(f"{left}.{k}"), F.col(f"{right}.{k}")
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(lambda x, y: x & y, [same(k) for k in keys])


def _first_match(clauses: list[Clause]) -> Column:
    """Index of the first clause whose condition is true; a NULL condition is no match."""
    chain = F.when(F.lit(False), F.lit(-1))
    for i, clause in enumerate(clauses):
        chain = chain.when(_as_column(clause.condition), F.lit(i))
    return chain


def known_keys(
    target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = False, also: list[str] | None = None
) -> DataFrame:
    """Distinct keys that both sides have, with further target columns if asked for.

    Only the key columns of the target are read, and nothing the source does not mention is kept.
    """
    same = _same_key("t", "s", keys, null_safe)
    return target.select(*keys, *(also or [])).alias("t").join(source.select(*keys).alias("s"), same, "left_semi").distinct()


def check_single_match(known: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = False) -> None:
    """Raise if two source rows match one target row; ``known`` holds the target's keys.

    The usual case costs one partial aggregation of the source; the target is looked at only
    when the source does repeat a key.
    """
    repeated = source.groupBy(*keys).count().filter("count > 1").select(*keys)
    if repeated.isEmpty():
        return
    clash = known.select(*keys).alias("t").join(repeated.alias("s"), _same_key("t", "s", keys, null_safe), "left_semi")
    if not clash.isEmpty():
        raise DuplicateSourceRows(f"several source rows match one target row on {keys}")


def matched_rows(
    target: DataFrame, source: DataFrame, keys: list[str], clauses: list[Clause], null_safe: bool = False
) -> DataFrame:
    """The target after the WHEN MATCHED clauses.

    A left join, not a full outer one: the source may then be broadcast when it is small, and
    a hot key on the target side can be split by adaptive execution.
    """
    matched = [c for c in clauses if c.kind in (UPDATE, DELETE)]
    if not matched:
        return target
    joined = (
        target.alias("t")
        .join(source.withColumn("__hit", F.lit(True)).alias("s"), _same_key("t", "s", keys, null_safe), "left")
        .withColumn("__clause", F.when(F.col("s.__hit"), _first_match(matched)))
    )
    deletes = [i for i, c in enumerate(matched) if c.kind == DELETE]
    if deletes:
        joined = joined.filter(~F.coalesce(F.col("__clause").isin(deletes), F.lit(False)))
    types = {f.name: f.dataType for f in target.schema.fields}

    def value_of(name: str) -> Column:
        chain = None
        for i, clause in enumerate(matched):
            if clause.kind == DELETE:
                continue
            if clause.values is None:
                new = F.col(f"s.{name}") if name in source.columns else None
            else:
                new = _as_column(clause.values[name]) if name in clause.values else None
            if new is not None:
                hit = F.col("__clause") == i
                new = new.cast(types[name])
                chain = F.when(hit, new) if chain is None else chain.when(hit, new)
        old = F.col(f"t.{name}")
        return old if chain is None else chain.otherwise(old).alias(name)

    return joined.select(*[value_of(c) for c in target.columns])


def inserted_rows(
    known: DataFrame, source: DataFrame, keys: list[str], clauses: list[Clause], schema: T.StructType, null_safe: bool = False
) -> DataFrame | None:
    """Rows that the WHEN NOT MATCHED clauses add, or None without such a clause.

    ``known`` are the keys found on both sides (:func:`known_keys`), ``schema`` is the target's.
    """
    inserts = [c for c in clauses if c.kind == INSERT]
    if not inserts:
        return None
    fresh = (
        source.alias("s").join(known.select(*keys).alias("t"), _same_key("t", "s", keys, null_safe), "left_anti")
        .withColumn("__clause", _first_match(inserts)).filter(F.col("__clause").isNotNull())
    )

    def value_of(field: T.StructField) -> Column:
        chain = F.when(F.lit(False), F.lit(None).cast(field.dataType))
        for i, clause in enumerate(inserts):
            if clause.values is None:
                new = F.col(f"s.{field.name}") if field.name in source.columns else F.lit(None)
            else:
                new = _as_column(clause.values[field.name]) if field.name in clause.values else F.lit(None)
            chain = chain.when(F.col("__clause") == i, new.cast(field.dataType))
        return chain.alias(field.name)

    return fresh.select(*[value_of(f) for f in schema.fields])


def merge_rows(
    target: DataFrame, source: DataFrame, keys: list[str], clauses: list[Clause], null_safe: bool = False
) -> DataFrame:
    """The whole target after all clauses, as one lazy DataFrame.

    The caller answers for the source matching each target row at most once
    (:func:`check_single_match`) and for giving the same rows each time it is read.
    """
    survivors = matched_rows(target, source, keys, clauses, null_safe)
    added = inserted_rows(known_keys(target, source, keys, null_safe), source, keys, clauses, target.schema, null_safe)
    return survivors if added is None else survivors.unionByName(added)


def split_keys(keys: str | list[str]) -> list[str]:
    """'a, b' or ['a', 'b'] to ['a', 'b']."""
    parts = keys.split(",") if isinstance(keys, str) else keys
    names = [k.strip() for k in parts if k.strip()]
    if not names:
        raise ValueError("at least one key column is needed")
    return names


def column_map(target_columns: list[str], source_columns: list[str]) -> dict[str, Column]:
    """Every target column from the source, NULL where the source lacks it."""
    return {c: F.col(f"s.{c}") if c in source_columns else F.lit(None) for c in target_columns}
