import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from millrace.llm import language, mixing
from millrace.session import scratch
from test_searches import brute_components
from test_texts import check_packed


def step(spark, name, docs):
    path = scratch(spark, f"test-{name}")
    dict(cp.STAGES)[name](spark, docs, "").write.parquet(path)
    return spark.read.parquet(path)


def without_repeats(rows, length=200):
    raw = [(r.doc_id, (r.text or "").encode()) for r in rows]
    seen = collections.Counter(t[i : i + length] for _, t in raw for i in range(len(t) - length + 1))
    out = {}
    for key, t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        left = bytes(np.frombuffer(t, np.uint8)[~gone]).decode("utf-8", "ignore")
        if left.strip(" "):
            out[key] = left
    return out


def test_stages_in_turn_equal_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["language", "similar", "repeats", "mixing", "packing"]
    known = step(spark, "language", docs)
    labels = {r.doc_id: r for r in language.label(docs, language.fit(docs), ["doc_id"]).collect()}
    assert {r.doc_id for r in known.collect()} == {k for k, r in labels.items() if r.lang_pred != "und" and r.score >= cp.LEAST_LIKELY}
    rows = known.collect()
    assert len(rows) >= 0.97 * docs.count()
    single = step(spark, "similar", known)
    parts = brute_components([(r.doc_id, r.text) for r in rows], cp.WORDS, cp.PERCENT)
    assert sorted(r.doc_id for r in single.collect()) == sorted(k for k, (n, c) in parts.items() if not n or c == k)
    cleaned = step(spark, "repeats", single)
    want = without_repeats(single.collect())
    got = {r.doc_id: r for r in cleaned.collect()}
    assert {k: r.text for k, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())
    mixed = step(spark, "mixing", cleaned)
    sized = cleaned.withColumn("size", mixing.word_count(F.col("text")))
    copies = {r.doc_id: r.copies for r in mixing.mix(sized).collect()}
    assert collections.Counter(r.doc_id for r in mixed.collect()) == collections.Counter({k: n for k, n in copies.items() if n})
    for df in (known, single, cleaned, mixed):
        assert df.columns == docs.columns and df.dtypes == docs.dtypes
    packed = step(spark, "packing", mixed)
    tokens, sequences = check_packed(packed.collect(), [(r.doc_id, r.text) for r in mixed.collect()])
    assert sequences <= 1.02 * tokens / 1024 + 4


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_edge_rows(spark, docs, no_docs, name):
    extra = {c: F.lit("clash") for c in ("score", "lang_pred", "component_id", "kept", "spans", "key", "size", "copies", "target", "offset", "ids", "n", "bytes")}
    got = step(spark, name, docs.withColumns(extra))
    if name != "packing":
        assert got.columns == [*docs.columns, *extra]
        texts = [r.text for r in got.filter("doc_id = 2").collect()]
        assert len(texts) == {"language": 2, "similar": 0, "repeats": 0}.get(name, len(texts))
    assert step(spark, name, no_docs).count() == 0


def test_one_of_repeated_rows_stays(spark):
    rows = [(5, "w1 w2 w3 w4 w5 w6", "en", "a", 1)] * 3 + [(4, None, "en", "a", 1)] * 2 + [(6, "other words stand in this one here", "en", "a", 1)]
    got = step(spark, "similar", spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert sorted(r.doc_id for r in got.collect()) == [4, 4, 5, 6]


def near_groups(rows, words=5, percent=80):
    """Smallest id of each row's group, by comparing all pairs."""
    sets = {}
    for key, text in rows:
        w = text.lower().split()
        sets[key] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    group = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and group[a] != group[b] and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {k: low if g == high else g for k, g in group.items()}
    return group


def test_similar_stage_takes_five_words_and_eight_tenths(spark):
    rng = np.random.default_rng(11)
    rows = []
    for g in range(30):
        base = [f"g{g}w{i}" for i in range(int(rng.integers(5, 140)))]
        rows.append(base)
        rows += [base + [f"g{g}more{n}x{i}" for i in range(int(len(base) * share))] for n, share in enumerate((0.1, 0.19, 0.22, 0.25, 0.3))]
        for n, share in enumerate((0.05, 0.08, 0.1, 0.13)):
            size = max(1, int(len(base) * share))
            at = int(rng.integers(0, len(base) - size + 1))
            rows.append([*base[:at], *(f"g{g}new{n}x{i}" for i in range(size)), *base[at + size :]])
    texts = [(int(i), " ".join(w), "en", "a", 1) for i, w in zip(rng.permutation(len(rows)), rows)]
    got = step(spark, "similar", spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").repartition(4))
    near, tight = near_groups([t[:2] for t in texts]), near_groups([t[:2] for t in texts], 4, 85)
    kept = sorted(r.doc_id for r in got.collect())
    assert kept == sorted(k for k, g in near.items() if k == g) and len(kept) < sum(k == g for k, g in tight.items())


def test_documents_without_languages_stay(spark, docs):
    got = step(spark, "language", docs.withColumn("lang", F.lit(None).cast("string")))
    assert got.columns == docs.columns and got.count() == docs.filter(language.has_letter(F.col("text"))).count() > 0
