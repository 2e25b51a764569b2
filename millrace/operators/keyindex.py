"""Which files of a table may hold a key: smallest and largest key and a Bloom filter per file.

A filter has sixteen bits a row, rounded up to a power of two, in pieces of 32,768 bits; a key sets
four of them. The pieces of a file are rows of a Parquet table beside the data, built with Spark's
bitmap aggregates, which combine before the shuffle. Looking up costs a join of the asked keys'
bits with the pieces they fall into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE = 32_768  # bits of one of Spark's bitmaps
BITS, HASHES = 16, 4
MOST_TESTS = 20_000_000  # keys times files; beyond it only ranges are used, as so many keys hit most files anyway


def _bits_of_file(rows: int) -> int:
    return PIECE << max(0, -(-rows * BITS // PIECE) - 1).bit_length()


def _positions(keys: list[str], bits: Column) -> Column:
    """The places of a key in a filter of so many bits. A null key has places too."""
    first, second = F.pmod(F.xxhash64(*keys), bits), F.pmod(F.xxhash64(*keys, F.lit(1)), bits)
    return F.array(*[(first + second * i) % bits for i in range(HASHES)])


def write(rows: DataFrame, keys: list[str], counts: dict[str, int], path: str) -> None:
    """Index new files: ``rows`` holds their keys and ``__part``, the file; ``counts`` the rows of each file."""
    spark = rows.sparkSession
    lows = [F.min(k).alias(f"low_{i}") for i, k in enumerate(keys)]
    highs = [F.max(k).alias(f"high_{i}") for i, k in enumerate(keys)]
    rows.groupBy("__part").agg(*lows, *highs).coalesce(1).write.parquet(f"{path}/ranges")
    sizes = spark.createDataFrame([(part, _bits_of_file(n)) for part, n in counts.items()], "__part string, bits long")
    placed = rows.join(F.broadcast(sizes), "__part").select("__part", "bits", F.explode(_positions(keys, F.col("bits"))).alias("at"))
    pieces = placed.groupBy("__part", "bits", F.floor(F.col("at") / PIECE).cast("long").alias("piece")).agg(F.bitmap_construct_agg(F.col("at") % PIECE).alias("bitmap"))
    pieces.write.parquet(f"{path}/filters")


def _is_set(bitmap: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), at % 8)).cast("long") % 2 == 1


def candidates(spark: SparkSession, folders: list[str], asked: DataFrame, keys: list[str], files: int, null_safe: bool = False) -> set[str]:
    """The files that may hold one of the asked keys. Collects at most one name for each file."""
    if not folders:
        return set()
    ranges = spark.read.parquet(*[f"{f}/ranges" for f in folders])
    if not null_safe:  # ranges say nothing about nulls
        asked = asked.dropna(subset=keys)
        limits = asked.agg(*[f(k).alias(f"{n}{i}") for i, k in enumerate(keys) for f, n in ((F.min, "least_"), (F.max, "most_"))]).first()
        if limits["least_0"] is None:
            return set()
        for i in range(len(keys)):
            ranges = ranges.filter((F.col(f"high_{i}") >= F.lit(limits[f"least_{i}"])) & (F.col(f"low_{i}") <= F.lit(limits[f"most_{i}"])))
    near = {r["__part"] for r in ranges.select("__part").distinct().collect()}
    distinct = asked.distinct()
    if not near or distinct.limit(MOST_TESTS // files + 1).count() * files > MOST_TESTS:
        return near
    filters = spark.read.parquet(*[f"{f}/filters" for f in folders])
    sizes = [r["bits"] for r in filters.select("bits").distinct().collect()]  # powers of two: a few
    tests = distinct.select(F.xxhash64(*keys).alias("key"), F.explode(F.array(*[F.struct(F.lit(b).cast("long").alias("bits"), _positions(keys, F.lit(b).cast("long")).alias("at")) for b in sizes])).alias("t"))
    tests = tests.select("key", "t.bits", F.explode("t.at").alias("at")).withColumn("piece", F.floor(F.col("at") / PIECE).cast("long"))
    # Shuffled joins: both the filters and what is asked grow with their tables, and a broadcast passes through the driver.
    met = tests.join(filters.hint("merge"), ["bits", "piece"]).filter(_is_set(F.col("bitmap"), F.col("at") % PIECE))
    whole = met.groupBy("__part", "key").agg(F.count_distinct("at").alias("met"))
    # Two of a key's places may be one.
    wanted = tests.groupBy("key", "bits").agg(F.count_distinct("at").alias("asked"))
    sized = filters.select("__part", "bits").distinct()
    hits = whole.join(sized, "__part").join(wanted.hint("merge"), ["key", "bits"]).filter("met = asked").select("__part").distinct()
    return near & {r["__part"] for r in hits.collect()}
