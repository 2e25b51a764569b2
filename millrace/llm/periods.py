"""Periodic runs of words: stretches that repeat a shorter stretch over and over.

The first phase of a grouping suffix sorter runs over a text's words, once under an order of the
words and once under its reverse. Positions start in one group per word. Groups are taken from the
highest down; each member hands its group's stretch to the nearest position on its left that has
not been taken yet, and positions that got the same stretch equally often move on together into a
group of their own just above their old one. When a position is taken, the stretch of its group is
the longest Lyndon word that starts there. Every run has such a word, under one of the two orders,
as its root at each place where the root fits (the runs theorem), so extending the roots by
longest common extensions to both sides finds all runs and each only once per order.

Everything of one text happens in one task; a text needs some hundred bytes a word there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.registry import query
from millrace.llm.texts import as_bytes, slices, table_of, tidy
from millrace.tables import table

WORD = r"[^\x20\x09-\x0D]+"
LEAST, EXPONENT = 6, 4  # words of a run, and how often it holds its period, at least
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
Run = tuple[int, int, int]


def lyndon_lengths(places: list[list[int]], n: int, rising: bool) -> list[int]:
    """Length of the longest Lyndon word that starts at each of the places 1 to n (entry 0 is unused).

    ``places`` holds the places of each word, ascending; words are ordered by their index in it, or by
    its reverse. The end of the text is smaller than every word.
    """
    words = len(places)
    group, members, length = [0] * (n + 1), list(places), [1] * words
    for g, own in enumerate(places):
        for s in own:
            group[s] = g
    lower = list(range(-1, words - 1)) if rising else [*range(1, words), -1]
    higher = [*range(1, words), -1] if rising else list(range(-1, words - 1))
    before, after = list(range(-1, n + 1)), list(range(1, n + 3))  # places not taken yet, as a linked list
    out = [0] * (n + 1)
    g = (words - 1 if rising else 0) if n else -1
    while g >= 0:
        size, given = length[g], {}
        for s in members[g]:
            if group[s] == g:
                out[s] = size
                left, right = before[s], after[s]
                after[left], before[right] = right, left
                if left:
                    given[left] = given.get(left, 0) + 1
        if given:
            moved: dict[tuple[int, int], list[int]] = {}
            for s, times in given.items():
                old = group[s]
                if len(members[old]) == 1:
                    length[old] += times * size  # alone in its group: the group moves with it
                else:
                    moved.setdefault((-times, old), []).append(s)
            for (times, old), own in sorted(moved.items()) if len(moved) > 1 else moved.items():
                new, above = len(length), higher[old]
                length.append(length[old] - times * size)
                members.append(own)
                lower.append(old)
                higher.append(above)
                higher[old] = new
                if above >= 0:
                    lower[above] = new
                for s in own:
                    group[s] = new
        g = lower[g]
    return out


def _alike(a: np.ndarray, b: np.ndarray) -> int:
    """How many entries two arrays have in common at their start."""
    done, size, most = 0, 64, min(len(a), len(b))
    while done < most:
        differ = a[done : min(done + size, most)] != b[done : min(done + size, most)]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done, size = done + size, size * 2
    return most


def runs_of(words: list, least: int = LEAST, exponent: int = EXPONENT) -> list[Run]:
    """(start, length, period) of every run of a sequence, by start, then period.

    A run has ``least`` words and ``exponent`` (2 or more) times its smallest period at least, and cannot be
    extended to either side.
    """
    n, ids = len(words), {}
    if n < max(least, exponent):
        return []
    text = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int32, n)
    places: list[list[int]] = [[] for _ in ids]
    for i, w in enumerate(text.tolist(), 1):
        places[w].append(i)
    found, back, here = set(), text[::-1], np.arange(n)
    for rising in (True, False):
        period = np.array(lyndon_lengths(places, n, rising)[1:])
        start = here[here + (exponent - 1) * period <= n]  # from its first root on, a run has room for one period less
        for k in range(1, exponent - 1):
            start = start[text[start] == text[start + k * period[start]]]
        end: dict[int, int] = {}
        for i, p in zip(start.tolist(), period[start].tolist()):
            if end.get(p, -1) >= i + p:
                continue  # a further root of the run before
            low = i - _alike(back[n - i :], back[n - i - p :])
            high = i + p + _alike(text[i:], text[i + p :])
            if high - low >= 2 * p:
                end[p] = high
                if high - low >= max(least, exponent * p):
                    found.add((low, high - low, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def without_repeats(words: list[bytes], found: list[Run]) -> bytes:
    """The words, joined by one space, without those that a run holds behind its first period."""
    if not found:
        return b" ".join(words)
    keep = bytearray(b"\x01") * len(words)
    for start, length, period in found:
        keep[start + period : start + length] = bytes(length - period)
    return b" ".join([w for w, k in zip(words, keep) if k])


def periodic_runs(docs: DataFrame, keep: list[str], text: Column | None = None, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """Columns ``keep`` of every document, its ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are split at white space and compared byte by byte. ``collapsed`` holds the words, joined by one
    space, without those in a run behind its first period. A null, empty or blank text has no runs and
    an empty ``collapsed``. Rows are treated one by one, repeated ones too; other columns do not matter.
    """
    kinds = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stream:
            for batch in slices(whole):
                found, left = [], []
                for value in batch.column(batch.num_columns - 1):
                    words = value.as_py().split()
                    found.append(runs_of(words, least, exponent))
                    left.append(without_repeats(words, found[-1]))
                offsets = np.cumsum([0, *map(len, found)])
                flat = np.array([r for own in found for r in own], np.int64).reshape(-1, 3)
                rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(kinds))
                runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
                yield table_of(batch, keep, runs=runs, __collapsed=pa.array(left, pa.binary()))

    rows = docs.select(*keep, as_bytes(F.col("text") if text is None else text).alias("__text"))
    schema = docs.select(*keep).schema.add("runs", T.ArrayType(RUN)).add("__collapsed", "binary")
    done = rows.mapInArrow(tidy(batches), schema)
    return done.withColumn("collapsed", F.col("__collapsed").cast("string")).drop("__collapsed")


def made_periodic(doc_id: Column, text: Column) -> Column:
    """A tenth of the texts repeat some of their words from some word on, as the id's crc32 says; a null id changes nothing."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def changed(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        taken = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, taken(i))), " ")

    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    # The words are found once, as the one entry of an array, however often the rule looks at them.
    once = F.get(F.transform(F.array(words), changed), F.lit(0))
    return F.when((h % 10 == 0) & (F.regexp_count(text, F.lit(WORD)) > 0), once).otherwise(text)


def run_digest(runs: Column) -> Column:
    """SHA-256 over a line ``start,length,period`` of every run."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return F.sha2(F.array_join(F.transform(runs, line), "").cast("binary"), 256)


@query("op13_periods")
def op13_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of all documents, a tenth of which are made periodic."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = periodic_runs(docs, ["doc_id"], made_periodic(F.col("doc_id"), F.col("text")))
    longer = lambda best, r: F.when(r["length"] > F.coalesce(best["length"], F.lit(0)), r).otherwise(best)
    none = F.lit(None).cast(RUN)
    best = F.aggregate("runs", none, longer).alias("best")
    return found.select("doc_id", "runs", "collapsed", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        run_digest(F.col("runs")).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
