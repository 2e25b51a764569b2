"""Keys that hold very many rows: find them, and split their rows evenly.

Adaptive execution splits a skewed join only if both sides are freshly shuffled for it. It
cannot if one side comes out of an aggregation or join on the same key. These helpers then
do it by hand, for any share of rows in one key, copies of one row included.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch

BROADCAST_KEYS = 100_000  # more large keys than this are joined by shuffle
SAMPLED_ROWS = 200


def _same(keys: list[str]):
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])


def large_keys(rows: DataFrame, keys: list[str], limit: int) -> DataFrame | None:
    """Keys with more than ``limit`` rows and the number of parts they need, or None without any.

    An action. A sample that holds about 200 rows of a key at the limit names the candidates, so
    little is shuffled; only candidates are then counted exactly. A key at the limit stays
    unnoticed with a probability under one in a billion, and is then merely not split.
    """
    fraction = min(1.0, SAMPLED_ROWS / limit)
    narrow = rows.select(*keys)
    sampled = narrow if fraction == 1.0 else narrow.sample(fraction, seed=7)
    candidates = sampled.groupBy(*keys).count().filter(F.col("count") >= limit * fraction / 2)
    candidates = candidates.select(*[F.col(k).alias(f"__{k}") for k in keys])
    n = candidates.count()
    if n == 0:
        return None
    candidates = F.broadcast(candidates) if n <= BROADCAST_KEYS else candidates
    found = (
        narrow.join(candidates, _same(keys), "left_semi").groupBy(*keys).count().filter(F.col("count") > limit)
        .select(*[F.col(k).alias(f"__{k}") for k in keys], F.ceil(F.col("count") / limit).alias("__parts"))
    )
    # Written once: the caller joins it to both sides, and must see the same keys in each.
    path = scratch(rows.sparkSession, "large-keys")
    found.write.parquet(path)
    found = rows.sparkSession.read.schema(found.schema).parquet(path)
    n = found.count()
    if n == 0:
        return None
    return F.broadcast(found) if n <= BROADCAST_KEYS else found


def with_parts(df: DataFrame, keys: list[str], large: DataFrame) -> DataFrame:
    """Add ``__parts``, NULL for keys that are not large."""
    return df.join(large, _same(keys), "left").drop(*[f"__{k}" for k in keys])


def numbered_part(df: DataFrame, keys: list[str], large: DataFrame, into: str) -> DataFrame:
    """Add the part each row belongs to, evenly within a large key, 0 for all others.

    Rows are split by number, so ``df`` should be a scan: after a shuffle, a task that is run
    again may number its rows differently.
    """
    numbered = with_parts(df.withColumn("__row", F.monotonically_increasing_id()), keys, large)
    return numbered.withColumn(into, F.coalesce(F.pmod("__row", F.col("__parts")), F.lit(0))).drop("__row", "__parts")


def join_hot_keys(
    rows: DataFrame, other: DataFrame, keys: list[str], how: str = "inner", null_safe: bool = False, limit: int = 5_000_000
) -> DataFrame:
    """Join a scan in which a key may be hot to rows that hold each key once or a few times.

    Both sides name the key columns alike; the result has them once. The rows of a key with
    more than ``limit`` rows are spread over several tasks, and ``other``'s rows of that key
    are repeated in each.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins can split the left side")
    large = large_keys(rows, keys, limit)
    on = list(keys)
    if large is not None:
        rows = numbered_part(rows, keys, large, "__part")
        last = F.coalesce(F.col("__parts") - 1, F.lit(0))
        other = with_parts(other, keys, large).withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("__parts")
        on.append("__part")
    if not null_safe:
        return rows.join(other, on, how).drop("__part")
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in on])
    rest = [F.col(f"r.{c}") for c in other.columns if c not in on]
    return rows.alias("l").join(other.alias("r"), same, how).select("l.*", *rest).drop("__part")
