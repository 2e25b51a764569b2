"""Joins of two streams."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def enrich_stream(stream: DataFrame, other: DataFrame, keys: list[str], salts: int = 1) -> DataFrame:
    """Inner join of two streams on shared keys, whenever their rows come.

    Any row may still meet one to come, so all rows of both sides stay as state, for ever: right
    for sides that end or stay small. Where rows that belong together lie near in time, use
    :func:`interval_join`. With ``salts`` > 1 a hot key's rows on the left spread over that many tasks,
    and each row of ``other`` is held that many times: worth it if ``other`` is the small side.
    """
    if salts == 1:
        return stream.join(other, keys, "inner")
    # Drawn, not hashed: copies of one row have to spread as well.
    left = stream.withColumn("__salt", F.floor(F.rand(7) * salts).cast("int"))
    right = other.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return left.join(right, [*keys, "__salt"], "inner").drop("__salt")


def interval_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, before: str, after: str,
    left_late: str = "0 seconds", right_late: str = "0 seconds", how: str = "inner", long_batches: bool = False,
) -> DataFrame:
    """Rows of two streams with equal keys whose times lie near: right from ``before`` its left row to ``after`` it.

    A stream's rows may come out of order by its ``late`` time at most; what is later still is left out. The
    slower of the two watermarks tells when no partner of a row can come any more. Then the row leaves
    the state and, in a ``left`` join without a partner, is put out with nulls, so the state holds about
    ``before`` + ``after`` and the lateness of rows, however long the streams run. Null keys meet nothing. The columns
    are those of left, then those of right without the keys; other names have to differ. Batches are
    joined alike.

    A batch compares all rows of a key that it or the state holds. If batches span much more time than the range, as
    when catching up, set ``long_batches``: times are cut into stretches as long as the range, a left row is held in its own,
    a right row in the two that can hold its partners, and only rows of one stretch are compared. A busy key's rows then
    spread over tasks; the state has its right rows twice. Ranges in months and other times than timestamps go without.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"an interval join is inner or left, not {how}")
    twice = (set(left.columns) & set(right.columns)) - set(keys)
    if twice:
        raise ValueError(f"both sides have columns {sorted(twice)}")
    renamed = {k: f"__right_{k}" for k in keys}
    left = left.withWatermark(left_time, left_late) if left.isStreaming else left
    right = (right.withWatermark(right_time, right_late) if right.isStreaming else right).withColumnsRenamed(renamed)
    near = (F.col(right_time) >= F.col(left_time) - F.expr(f"INTERVAL {before}")) & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {after}"))
    micros = _micros(left, right, left_time, right_time, before, after) if long_batches else None
    if micros and sum(micros) > 0:
        left = left.withColumn("__stretch", _stretch(left_time, 0, sum(micros)))
        first, last = _stretch(right_time, -micros[1], sum(micros)), _stretch(right_time, micros[0], sum(micros))
        right = right.withColumn("__right_stretch", F.explode(F.sequence(first, last)))
        keys, renamed = [*keys, "__stretch"], renamed | {"__stretch": "__right_stretch"}
    for k in keys:
        near = near & (F.col(k) == F.col(renamed[k]))
    return left.join(right, near, how).drop("__stretch", *renamed.values())


def _micros(left: DataFrame, right: DataFrame, left_time: str, right_time: str, before: str, after: str) -> list[int] | None:
    """Microseconds before and after, if they bound the range at any time."""
    if {left.schema[left_time].dataType, right.schema[right_time].dataType} != {T.TimestampType()}:
        return None
    spark = left.sparkSession
    both = spark.sql(f"SELECT INTERVAL {before} AS before, INTERVAL {after} AS after")
    if not all(isinstance(f.dataType, T.DayTimeIntervalType) for f in both.schema.fields):
        return None
    sides = list(both.first())
    # Days are those of the session's zone, where one may be longer or shorter.
    by_day = spark.conf.get("spark.sql.session.timeZone") != "UTC" and any(abs(x) >= timedelta(days=1) for x in sides)
    return [(x + timedelta(days=int(by_day))) // timedelta(microseconds=1) for x in sides]


def _stretch(time: str, later: int, length: int) -> Column:
    """The number of the stretch of a time, or of one some microseconds later."""
    return F.floor((F.unix_micros(F.col(time)) + F.lit(later).cast("long")) / F.lit(length)).cast("long")
