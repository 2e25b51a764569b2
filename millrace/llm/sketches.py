"""Fingerprints of documents by threshold-scaled sketches, with DataFrame operations only.

A sketch holds the hash of every shingle of a text (five words) that lies below a fixed fraction of all
hashes. A larger text has a larger sketch, so the share of one sketch that another holds estimates how
much of the one text the other contains, however unequal they are. The union of the sketches of parts
is the sketch of the whole (shingles across a border aside), so sketches can be merged, and a sketch
of a smaller fraction is a filter over one of a larger.

``followed`` gives every document the one behind it in an order: rows are dealt into ranges of the
order, which are cut at keys that the rows themselves hold, and each range gets the first row of the
next one as its last. Texts are shuffled once.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.registry import query
from millrace.tables import table

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 5
SHARE = 0.25  # of all hashes: some 95 of a document of 380 words
DIGITS = 16  # hexadecimal digits of a hash
RANGES = 4  # ranges of the order for each shuffle partition
KEY = "struct<missing: boolean, rest: bigint, digest: string>"


def sketch(text: Column, words: int = WORDS, share: float = SHARE) -> Column:
    """Sorted array of the retained hashes of a text's shingles.

    A-Z count as a-z; words are split at white space. A text with fewer words is one shingle, one without words
    or a null has none. A text whose few hashes all lie above the threshold has an empty sketch too.
    """
    limit = f"{min(int(share * 16**DIGITS), 16**DIGITS - 1):0{DIGITS}x}"
    found = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))

    def retained(w: Column) -> Column:
        # get() gives null beyond the end, which concat_ws leaves out.
        shingle = lambda i: F.md5(F.concat_ws(" ", *[F.get(w, i + k) for k in range(words)]).cast("binary"))
        last = F.when(F.size(w) > 0, F.greatest(F.size(w) - words, F.lit(0)))
        hashes = F.filter(F.transform(F.sequence(F.lit(0), last), shingle), lambda h: h < limit)
        return F.sort_array(F.array_distinct(F.transform(hashes, lambda h: F.substring(h, 1, DIGITS))))

    # The words are found once, as the one entry of an array, however often the shingles look at them.
    return F.coalesce(F.get(F.transform(F.array(found), retained), F.lit(0)), F.array().cast("array<string>"))


def shared(a: Column, b: Column) -> Column:
    """How many hashes two sketches share."""
    return F.size(F.array_intersect(a, b))


def containment(both: Column, a: Column) -> Column:
    """Share of a sketch of ``a`` hashes that another holds, ``both`` being what they share; 0 where it is empty."""
    return F.when(a > 0, both / a).otherwise(F.lit(0.0))


def likeness(both: Column, a: Column, b: Column) -> Column:
    """Share of the smaller sketch (``a`` and ``b`` hashes) that the larger holds, 0 to 1; 0 where one is empty."""
    return containment(both, F.least(a, b))


def resemblance(both: Column, a: Column, b: Column) -> Column:
    """Shared hashes of two sketches over all of them; 0 where both are empty."""
    return containment(both, a + b - both)


def merged(sketches: Column) -> Column:
    """The sketch of all texts behind an array of sketches."""
    return F.sort_array(F.array_distinct(F.flatten(sketches)))


def _range_of(key: Column, bounds: list, kind: str) -> Column:
    """Index of the last bound that is not behind the key, by halving; the first if there is none."""
    known = F.from_json(F.lit(json.dumps(bounds)), f"array<{kind}>")
    steps = [1 << k for k in reversed(range(max(1, (len(bounds) - 1).bit_length())))]
    onward = lambda at, s: F.when(F.coalesce(F.get(known, at + s) <= key, F.lit(False)), at + s).otherwise(at)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), onward)


def followed(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Rows (doc_id, text and more), each with ``next``: the carried columns of the row behind it by descending doc_id.

    Behind the last comes the first; a single row follows itself. Null ids come last. Rows of one id go by
    the md5 of their text, so an id that many rows share is cut into ranges like any other; rows alike
    in both follow one another in no certain order and stay in one range. A null text counts as empty.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    # The complement runs against the id without overflow.
    key = F.struct(F.col("doc_id").isNull().alias("missing"), F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(0)).alias("rest"), F.md5(text.cast("binary")).alias("digest"))
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = docs.select(key.alias("key")).repartitionByRange(ranges, "key").groupBy(F.spark_partition_id().alias("part"))
    # A key for each range, whatever the size of the table.
    firsts = sorted(tuple(r[0]) for r in parts.agg(F.min("key")).select("min(key)").collect())
    bounds = [{"missing": m, "rest": r, "digest": d} for m, r, d in firsts]
    rows = docs.withColumn("__key", key).withColumn("__range", _range_of(F.col("__key"), bounds, KEY)).withColumn("__end", F.lit(False))
    behind = [(i - 1) % len(bounds) for i in range(len(bounds))]
    cuts = spark.createDataFrame([(b["missing"], b["rest"], b["digest"], i) for b, i in zip(bounds, behind)], "missing boolean, rest long, digest string, place int")
    cuts = cuts.select(F.struct("missing", "rest", "digest").alias("__cut"), "place")
    # The rows that begin a range, once more as the last of the range before.
    heads = docs.withColumn("__key", key).join(F.broadcast(cuts), F.col("__key") == F.col("__cut")).dropDuplicates(["place"])
    heads = heads.drop("__cut").withColumnRenamed("place", "__range").withColumn("__end", F.lit(True))
    along = Window.partitionBy("__range").orderBy("__end", "__key")
    paired = rows.unionByName(heads.select(rows.columns)).withColumn("next", F.lead(F.struct(*carried)).over(along))
    return paired.filter(~F.col("__end")).drop("__key", "__range", "__end")


def edited(text: Column, other: Column) -> Column:
    """The text with its last half replaced by as much of the start of another."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(text.substr(F.lit(1), F.length(text) - half), other.substr(F.lit(1), half))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), turned AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC NULLS LAST, md5(text)), first_value(text) OVER (ORDER BY doc_id DESC NULLS LAST, md5(text))) AS other FROM d
), changed AS (
  SELECT *, substring(text, 1, length(text) - length(text) // 2) || substring(other, 1, length(text) // 2) AS edited FROM turned
), worded AS (
  SELECT *, row_number() OVER () AS r, [regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FOR t IN [text, edited, other]] AS words
  FROM changed
), tokens AS (
  SELECT r, k, len(words[k]) AS n, unnest(words[k]) AS w, generate_subscripts(words[k], 1) AS i FROM worded, range(1, 4) t(k)
), shingles AS (
  SELECT r, k, n, i, md5(concat_ws(' ', w, lead(w) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o)) AS h FROM tokens WINDOW o AS (PARTITION BY r, k ORDER BY i)
), sketched AS (
  SELECT r, k, list(DISTINCT substring(h, 1, 16) ORDER BY substring(h, 1, 16)) AS s FROM shingles WHERE i <= greatest(n - 4, 1) AND h < '4000000000000000' GROUP BY r, k
), hashed AS (
  SELECT w.*, coalesce(x.s, []::VARCHAR[]) AS a, coalesce(y.s, []::VARCHAR[]) AS b, coalesce(z.s, []::VARCHAR[]) AS c FROM worded w
  LEFT JOIN sketched x ON x.r = w.r AND x.k = 1 LEFT JOIN sketched y ON y.r = w.r AND y.k = 2 LEFT JOIN sketched z ON z.r = w.r AND z.k = 3
), counted AS (
  SELECT *, len(list_intersect(a, b)) AS ab, len(list_intersect(a, c)) AS ac FROM hashed
)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint, array_to_string(b, '') AS edited_fingerprint,
  CASE WHEN least(len(a), len(b)) > 0 THEN ab::DOUBLE / least(len(a), len(b)) ELSE 0.0 END AS near_edited,
  CASE WHEN least(len(a), len(c)) > 0 THEN ac::DOUBLE / least(len(a), len(c)) ELSE 0.0 END AS near_next,
  CASE WHEN len(a) + len(b) > 0 THEN ab::DOUBLE / (len(a) + len(b) - ab) ELSE 0.0 END AS jaccard_edited,
  CASE WHEN len(a) + len(c) > 0 THEN ac::DOUBLE / (len(a) + len(c) - ac) ELSE 0.0 END AS jaccard_next
FROM counted
"""


@query("op11_sketches", ORACLE)
def op11_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = followed(docs, ["text"]).withColumns({"other": F.col("next.text"), "own": sketch(F.col("text"))})
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("other")))
    rows = rows.withColumns({"changed": sketch(F.col("edited")), "behind": sketch(F.col("other"))})
    rows = rows.withColumns({"with_edited": shared(F.col("own"), F.col("changed")), "with_next": shared(F.col("own"), F.col("behind"))})
    own, changed, behind = F.size("own"), F.size("changed"), F.size("behind")
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_join("own", "").alias("fingerprint"), F.array_join("changed", "").alias("edited_fingerprint"),
        likeness(F.col("with_edited"), own, changed).alias("near_edited"), likeness(F.col("with_next"), own, behind).alias("near_next"),
        resemblance(F.col("with_edited"), own, changed).alias("jaccard_edited"), resemblance(F.col("with_next"), own, behind).alias("jaccard_next"),
    )
