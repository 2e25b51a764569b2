import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import periods
from millrace.llm.registry import QUERIES


def plain_runs(t, least=6, exponent=4):
    """Every stretch, period by period, by the definition of a run."""
    out = []
    for p in range(1, len(t) // exponent + 1):
        i = 0
        while i + p < len(t):
            j = i
            while j + p < len(t) and t[j] == t[j + p]:
                j += 1
            length = j + p - i
            if j > i and length >= max(least, exponent * p):
                part = t[i : i + length]
                if not any(all(part[k] == part[k + q] for k in range(length - q)) for q in range(1, p)):
                    out.append((i, length, p))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_lyndon(t, smaller):
    out = []
    for i in range(len(t)):
        best = 1
        for j in range(i + 1, len(t) + 1):
            part = t[i:j]
            if all(smaller(part, part[k:]) for k in range(1, len(part))):
                best = len(part)
        out.append(best)
    return out


REPEATS = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=4), st.integers(1, 6)), max_size=5).map(lambda x: [w for u, k in x for w in u * k])


@given(REPEATS | st.lists(st.integers(0, 2), max_size=30))
@settings(max_examples=300, deadline=None)
def test_runs_by_definition(t):
    assert periods.runs_of(t) == plain_runs(t)
    assert periods.runs_of(t, 2, 2) == plain_runs(t, 2, 2)


@given(st.lists(st.integers(0, 2), max_size=14))
@settings(max_examples=200, deadline=None)
def test_lyndon_words_of_both_orders(t):
    seen = list(dict.fromkeys(t))
    ranks = [seen.index(w) for w in t]
    places = [[i for i, w in enumerate(ranks, 1) if w == k] for k in range(len(seen))]
    assert periods.lyndon_lengths(places, len(t), True)[1:] == plain_lyndon(ranks, lambda a, b: a < b)
    down = [-r for r in ranks]
    assert periods.lyndon_lengths(places, len(t), False)[1:] == plain_lyndon(down, lambda a, b: a < b)


def test_very_long_texts():
    n = 200_000
    assert periods.runs_of([b"a"] * n) == [(0, n, 1)]
    assert periods.runs_of([b"a", b"b", b"c"] * n) == [(0, 3 * n, 3)]
    assert periods.runs_of(list(range(n)) * 4) == [(0, 4 * n, n)]
    assert periods.runs_of(list(range(n))) == []


def plain_collapse(words, found):
    return " ".join(w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, n, p in found))


def test_runs_on_tables(spark, docs, no_docs):
    clashing = docs.withColumns({"runs": F.lit("x"), "collapsed": F.lit("y"), "words": F.lit(1)})
    rows = periods.periodic_runs(clashing, ["doc_id", "n_chars"]).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        words = texts[r.doc_id].replace("\t", " ").replace("\n", " ").split(" ")
        words = [w for w in words if w]
        found = [tuple(x) for x in r.runs]
        assert found == (plain_runs(words) if len(words) < 2000 else [])
        assert r.collapsed == plain_collapse(words, found)
    assert next(r for r in rows if r.doc_id == 12).runs == [(0, 120, 3)]
    assert periods.periodic_runs(no_docs, ["doc_id"]).count() == 0


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, digest("".join(f"{s},{n},{p}\n" for s, n, p in found)), digest(plain_collapse(words, found)))


def test_query_against_the_definition(spark, small):
    texts = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in QUERIES["op13_periods"](spark, small).collect()}
    assert got == {expected(d, t) for d, t in texts} and len(got) == len(texts)


@pytest.fixture
def periodic(spark, folder):
    random.seed(5)
    rows = [(i, " ".join(random.choice("a b c".split()) for _ in range(random.randint(0, 60)))) for i in range(300)]
    rows += [(None, "x x x x x x x"), (301, None), (302, ""), (303, "a b \n" * 9), (304, "x " * 9), (304, "x " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def test_query_on_edge_rows(spark, periodic):
    folder, rows = periodic
    got = sorted((tuple(r) for r in QUERIES["op13_periods"](spark, folder).collect()), key=str)
    assert got == sorted((expected(d, t) for d, t in rows), key=str)
