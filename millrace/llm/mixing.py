"""Mixing sources to target weights by systematic sampling, with DataFrame operations only.

Every source gets a target in words. A document's expected number of copies is its source's
target over its source's size. The expected copies are added up within the source, one random
offset is added, and a document is taken once for every whole number its running sum crosses.

Documents run in the order of their size band (an eighth of an octave wide), a hash cell of their
id, size and id. Adding up goes in two steps, by (source, band, cell) and then within it, so a
source that holds a third of all rows is spread over many tasks. As sizes rise along the order, the
words taken from a source differ from its target by about the size of its largest document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.registry import query
from millrace.session import scratch
from millrace.tables import table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
CELLS = 64
ONE = 1 << 28  # one copy in fixed point
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _hex(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def _placed(rows: DataFrame) -> DataFrame:
    """Add the place in the order: a source key without nulls, size band and hash cell."""
    shift = F.greatest(F.length(F.bin("size")) - 4, F.lit(0))
    return rows.withColumns({
        "__key": F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source")),
        "__band": (shift * 16 + F.floor(F.col("size") / F.pow(F.lit(2.0), shift))).cast("long"),
        "__cell": _hex(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 2) % CELLS,
    })


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The target of each source, from rows (source, size).

    Sources in code point order, null last, take the weights in turn and share all words. A target
    stops at ``most`` times its source's size; the rest is shared again by weight. With the sources
    sorted by limit over weight, the level at which sharing ends is the largest of the levels found
    by fixing the first 0, 1, 2, ... sources at their limits. The windows hold one row per source.
    """
    everything = Window.partitionBy(F.lit(1))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    by_need = everything.orderBy(F.col("__limit") / F.col("__weight"), "__rank")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_need.rowsBetween(0, Window.unboundedFollowing)
    w = F.array(*[F.lit(x).cast("long") for x in weights])
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("__rank", F.row_number().over(by_name)).withColumns({
        "__weight": F.get(w, ((F.col("__rank") - 1) % len(weights)).cast("int")),
        "__limit": F.col("source_size") * most,
    })
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("__limit").over(before), F.lit(0))
    sources = sources.withColumn("__level", rest.cast("double") / F.sum("__weight").over(onward).cast("double"))
    level = F.max("__level").over(everything)
    target = F.least(F.col("__limit").cast("double"), level * F.col("__weight"))
    return sources.select("source", "source_size", target.alias("target"))


def mix(rows: DataFrame, stats: DataFrame | None = None, seed: str = SEED) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to rows that hold doc_id, source and size.

    Every other column of ``rows`` is kept; names starting with two underscores are reserved.
    ``stats`` may hold the same rows narrowed to (doc_id, source, size), to spare a wide scan.

    Null sizes count as 0. A null source is a source of its own, null ids share a cell. Repeated
    rows take part one by one; rows alike in source, id and size may swap their copies. A source
    without words has target 0 and no copies. An empty table gives an empty result.
    """
    rows = rows.withColumn("size", F.coalesce(F.col("size"), F.lit(0)).cast("long"))
    stats = rows.select("doc_id", "source", "size") if stats is None else stats
    targets = source_targets(stats)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.select(
        F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source")).alias("__key"),
        "source_size", "target", F.floor(share * ONE).cast("long").alias("__step"),
    )
    cells = _placed(stats).groupBy("__key", "__band", "__cell").agg(F.count(F.lit(1)).alias("__n")).join(targets, "__key")
    along = Window.partitionBy("__key").orderBy("__band", "__cell").rowsBetween(Window.unboundedPreceding, -1)
    offset = _hex(F.concat(F.lit(seed + "|"), "__key"), 7)
    start = (offset + F.col("__step") * F.coalesce(F.sum("__n").over(along), F.lit(0))) % ONE
    cells = cells.withColumn("__start", start).drop("__n")
    inside = Window.partitionBy("__key", "__band", "__cell").orderBy("size", "doc_id")
    numbered = _placed(rows).withColumn("__k", F.row_number().over(inside).cast("long"))
    crossed = lambda k: F.shiftright(F.col("__start") + F.col("__step") * k, 28)
    copies = crossed(F.col("__k")) - crossed(F.col("__k") - 1)
    joined = numbered.join(cells, ["__key", "__band", "__cell"])
    return joined.withColumn("copies", copies.cast("long")).drop("__key", "__band", "__cell", "__k", "__start", "__step")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), placed AS (
  SELECT *, greatest(length(bin(size)) - 4, 0) AS shift, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2))::BIGINT % 64 AS cell FROM d
), banded AS (
  SELECT doc_id, source, size, cell, shift * 16 + (size >> shift) AS band FROM placed
), named AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM d GROUP BY source
), weighed AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap FROM named
), levels AS (
  SELECT *, ((sum(source_size) OVER ()) - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM weighed
), targets AS (
  SELECT source, source_size, least(cap::DOUBLE, (max(level) OVER ()) * weight) AS target FROM levels
), steps AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 268435456)::BIGINT ELSE 0 END AS step,
    ('0x' || substr(md5('mix-1|' || CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END), 1, 7))::BIGINT AS shifted FROM targets
), ordered AS (
  SELECT b.doc_id, b.source, b.size, s.source_size, s.target, s.step, s.shifted,
    row_number() OVER (PARTITION BY b.source ORDER BY b.band, b.cell, b.size, b.doc_id NULLS FIRST) AS k
  FROM banded b JOIN steps s ON b.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, source, size, source_size, target, (((shifted + step * k) >> 28) - ((shifted + step * (k - 1)) >> 28)) * size AS taken FROM ordered
"""


@query("op6_mixing", ORACLE)
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    sized = table(spark, folder, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    path = scratch(spark, "mix-sizes")  # three readers need the sizes: count words once
    sized.write.parquet(path)
    mixed = mix(spark.read.schema(sized.schema).parquet(path))
    return mixed.select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
