import collections
import hashlib
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import neighbours, repeats, similar
from millrace.llm.graphs import components
from millrace.session import Steps, scratch


def brute(rows, wanted, top):
    """rows: (id, vector); the exact answers."""
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in ok:
        if q % wanted == 0:
            scores = sorted((-float(ok[q] @ v), i) for i, v in ok.items() if i != q)
            out[q] = [(i, -s) for s, i in scores[:top]]
    return out


def test_neighbours_edge_rows_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 8) * rng.uniform(0.2, 3)]) for i in range(1, 400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # one vector many times
    rows += [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] + [1.0] * 7), (1060, [None] + [1.0] * 7), (1080, [float("inf")] * 8), (None, rows[3][1])]
    df = spark.createDataFrame(rows + rows[:3], "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, "vec_id % 20 = 0").orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = brute(rows, 20, 20)
    assert set(got) == set(want)
    for q, best in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in best]
        assert np.allclose([s for _, s in got[q]], [s for _, s in best], atol=1e-9)


def test_neighbours_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.nearest(spark.createDataFrame([], schema), "vec_id % 20 = 0").count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (3, [0.0, 2.0])], schema)
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.nearest(two, "vec_id % 20 = 0").collect()] == [(0, 1, 3, 0.0)]
    with pytest.raises(ValueError):
        neighbours.nearest(two.unionAll(spark.createDataFrame([(4, [1.0])], schema)), "vec_id % 20 = 0")


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    want = brute(rows, 20, 20)
    got = collections.defaultdict(set)
    for r in neighbours.nearest(table, "vec_id % 20 = 0").collect():
        got[r.query_id].add(r.vec_id)
    found = sum(len(got[q] & {i for i, _ in best}) for q, best in want.items())
    assert found >= 0.9 * sum(map(len, want.values()))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and got[100] == got[95] == got[90] == 90
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def brute_components(rows, k_words=4, percent=85):
    sets = {i: shingle_set(t, k_words) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for k in ids[n + 1 :]:
            if sets[i] and sets[k] and 100 * len(sets[i] & sets[k]) >= percent * len(sets[i] | sets[k]):
                parent[max(root(i), root(k))] = min(root(i), root(k))
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("few, stars", [(32, 6), (1, 0), (500, 0), (4, 1)])
def test_similar_equals_brute_force(spark, monkeypatch, few, stars):
    monkeypatch.setattr(similar, "BLOCK", 16)
    monkeypatch.setattr(similar, "FEW", few)
    monkeypatch.setattr(similar, "STARS", stars)
    rng = np.random.default_rng(4)
    passage = [f"c{i}" for i in range(60)]
    rows = []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(int(rng.integers(5, 120)))]
        for _ in range(int(rng.integers(1, 12))):
            words = list(base)
            for at in rng.integers(0, len(words), int(rng.integers(0, 5))):
                words[at] = f"x{rng.integers(1000)}"
            rows.append(words + (passage if g % 3 == 0 else []))
    rows += [passage + [f"own{k}_{i}" for i in range(8 + k)] for k in range(30)]  # differ by little, and not by little enough
    texts = [(i * 3 % 1009, " ".join(w).upper() if i % 5 == 0 else "\n".join(w)) for i, w in enumerate(rows)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar.similar(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()}
    assert got == brute_components(texts)


def left(spark):
    """Labels of the folders that steps have left in the shared folder."""
    base = os.path.dirname(scratch(spark, "x"))
    return collections.Counter(x.rpartition("-")[0] for x in os.listdir(base)) if os.path.isdir(base) else collections.Counter()


@pytest.mark.parametrize("pairs, rows", [(250_000, 20_000_000), (3, 50)])
def test_similar_leaves_its_result_alone(spark, monkeypatch, pairs, rows):
    monkeypatch.setattr(similar, "PAIRS_AT_ONCE", pairs)
    monkeypatch.setattr(similar, "ROWS_AT_ONCE", rows)
    texts = [(7 * g + k, " ".join(f"g{g}w{i}" for i in range(60 + k))) for g in range(9) for k in range(1 + g % 5)]
    before = left(spark)
    got = similar.similar(spark.createDataFrame(texts, "doc_id long, text string").repartition(3))
    assert {k.removeprefix("/"): n for k, n in (left(spark) - before).items()} == {"similar": 1}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(texts)


def test_tokens_of_the_same_entries_are_one_cell(spark):
    rows = [(t, e, e % 5, 40) for t in range(1, 21) for e in range(100, 142) if (t + e) % 21 > 1]  # a family, two of 42 missing at each token
    rows += [(t, e, e, 34) for t in range(31, 34) for e in (500, *range(1000 * t, 1000 * t + 33))]  # tokens that share one entry
    with Steps(spark) as steps:
        got = similar._cells(spark.createDataFrame(rows, "token long, entry long, group long, __count long"), steps).collect()
    cells = collections.defaultdict(dict)
    for r in got:
        assert r.entry not in cells[r.cell]
        cells[r.cell][r.entry] = r.group
    family = [c for c in cells.values() if min(c) < 500]
    assert len(family) <= 8 and set().union(*family) == set(range(100, 142)) and all(g == e % 5 for c in family for e, g in c.items())
    met = {(c, e) for c, m in cells.items() for e in m}
    for t in {r[0] for r in rows}:  # the entries of a token are together somewhere
        assert any({e for k, e, *_ in rows if k == t} <= set(m) for m in cells.values())
    assert len(met) < len(rows) / 2 + 3 * 34 and sum(500 in m for m in cells.values()) in (1, 2, 3)


def test_opened_cells_find_what_all_pairs_find():
    rng = np.random.default_rng(12)
    for two in (False, True):
        base = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (40, 130, 135, 300)]
        sets = [np.unique(np.concatenate((b[rng.random(len(b)) > p], rng.integers(0, 1 << 63, int(len(b) * p), dtype=np.uint64)))) for b in base for p in rng.uniform(0, 0.14, 25)]
        ids, groups = rng.permutation(len(sets)) + 5, np.arange(len(sets)) // 2
        blocks = rng.integers(0, 2, len(sets)) if two else np.zeros(len(sets), int)
        pairs = {(int(min(ids[i], ids[k])), int(max(ids[i], ids[k]))) for i in range(len(sets)) for k in range(i) if not (two and blocks[i] == blocks[k]) and similar.linked(sets[i], sets[k], 80)}
        got = list(similar.opened(ids, groups, blocks, sets, [similar.bitmap(x) for x in sets], 80))
        group = dict(zip(ids.tolist(), groups.tolist()))

        def parts(links):
            at = {g: g for g in group.values()}
            for a, b in links:
                x, y = at[group[a]], at[group[b]]
                at = {g: min(x, y) if v in (x, y) else v for g, v in at.items()}
            return at

        assert set(got) <= pairs and parts(got) == parts(pairs) and len(got) < len(pairs)


def test_steps_end_with_their_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with Steps(spark) as steps:
        df = steps.written(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "test-steps")
        assert df.count() == 7 and len(steps.paths) == 1 and os.path.isdir(steps.paths[0])
    assert not os.path.exists(steps.paths[0]) and spark.conf.get(key, None) == before


def test_similar_on_a_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar.similar(docs).collect()}
    assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()])


def test_frequent_tokens_in_several_cells(spark, monkeypatch):
    monkeypatch.setattr(similar, "RUN", 10)
    words = [f"w{i}" for i in range(100)]
    texts = [(i, " ".join(words[:50] + [f"u{i}"] + words[50:])) for i in range(200)]
    got = similar.similar(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}


def test_similar_edge_rows(spark, docs, no_docs):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in similar.similar(docs.withColumn("component_id", F.lit("clash"))).collect()]
    assert len(got) == docs.count() and {(1, 20, 1), (2, 20, 1), (4, 0, 4), (5, 0, 5), (6, 0, 6), (None, 1, None), (9, 1, 9)} <= set(got)
    assert similar.similar(no_docs).count() == 0


def test_bounds_never_lose_a_link():
    rng = np.random.default_rng(7)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) > 0.08], rng.integers(0, 1 << 63, int(rng.integers(0, n // 10 + 2)), dtype=np.uint64))))
        if similar.linked(a, b, 85):
            maps = [similar.bitmap(a), similar.bitmap(b)]
            assert similar.may_link(len(a), len(b), *maps, 85)
            two = (np.array([1, 2]), np.array([1, 2]), np.array([0, 0]), [a, b])
            assert list(similar.opened(*two, maps, 85)) == [(1, 2)]


def test_suffix_order():
    rng = np.random.default_rng(3)
    for n, letters in ((0, 2), (1, 1), (60, 1), (300, 2), (1200, 26)):
        text = rng.integers(97, 97 + letters, n).astype(np.uint8)
        raw = text.tobytes()
        assert list(repeats.suffix_order(text, n + 1)) == sorted(range(n), key=lambda i: raw[i:])


def brute_repeats(texts, length=200):
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        left = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return out


def digests(df):
    rows = df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha")).collect()
    return {r.doc_id: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("many", [10_000, 3])
def test_repeats_equal_brute_force(spark, monkeypatch, many):
    monkeypatch.setattr(repeats, "MANY", many)
    monkeypatch.setattr(repeats, "BLOCK", 3000)
    rng = np.random.default_rng(6)
    text = lambda n: "".join(rng.choice(list("abcdefgh é\n"), n))
    shared, line = text(900), text(150)
    rows = [text(700) for _ in range(6)] + [shared, shared, shared[:350] + text(60) + shared[100:600], text(50) + shared[300:520]]
    rows += [text(100) + shared[k : k + 230 + 7 * k] + text(90) for k in range(0, 60, 3)]
    rows += [(line + "-") * 5, "ab" * 400, "a" * 950, "a" * 199, shared[:199], shared[:200], "x" + shared[:205], text(30) + "a" * 210]
    rows += [shared[:250] + f"{k}" + shared[251:700] for k in range(8)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = digests(repeats.remove_repeats(docs, ["doc_id"]))
    want = brute_repeats([r.encode() for r in rows])
    assert [got[i] for i in range(len(rows))] == want


def test_repeats_on_a_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.collect()
    got = digests(repeats.remove_repeats(docs, ["doc_id"]))
    assert [got[r.doc_id] for r in rows] == brute_repeats([(r.text or "").encode() for r in rows])


def test_repeats_edge_rows(spark, docs, no_docs):
    got = repeats.remove_repeats(docs.withColumn("kept", F.lit("clash")), ["doc_id"]).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == docs.count() and by[4].n_bytes == 0 and by[9].n_removed == 30_000 and by[2].n_removed == by[2].n_bytes
    assert by[7].n_removed == 0 and bytes(by[8].kept).decode() == "日本語のテキスト"
    assert repeats.remove_repeats(no_docs, ["doc_id"]).count() == 0


def test_similarities_that_shared_tokens_cannot_find_are_refused(docs):
    with pytest.raises(ValueError, match="67"):
        similar.similar(docs, percent=60)
