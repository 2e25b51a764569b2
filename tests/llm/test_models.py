import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language, toxicity
from millrace.llm.texts import held_out, pieces


def test_held_out_is_crc32_of_the_id_as_text(spark):
    rows = spark.range(-5, 200).select("id", held_out(F.col("id"), 5, 0).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)
    assert spark.sql("SELECT CAST(NULL AS LONG) AS id").select(held_out(F.col("id"), 5, 0)).first()[0] is False


def test_pieces_cover_texts():
    values = [b"", b"aa bb cc dd", b"x" * 25, b"one\ntwo " * 9]
    for hard in (True, False):
        got = {}
        for i, p in pieces(values, 10, hard):
            got[i] = got.get(i, b"") + p
            assert len(p) <= 10 or not hard
        assert [got[i] for i in range(4)] == values


@pytest.fixture(scope="module")
def toxic_words():
    rng = np.random.default_rng(0)
    words = ["mild", "river", "stone", "garden", "letter", "window", "paper", "silver", "yellow", "winter"]
    texts, labels = [], []
    for i in range(600):
        body = list(rng.choice(words, 60))
        if i % 3 == 0:
            for at in rng.integers(0, 60, 3):
                body[at] = rng.choice(["blasted", "rotten", "wretch"]) if i % 2 else rng.choice(["Rotten!", "wretch,"])
        texts.append(" ".join(body).encode())
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_toxicity_on_held_out_texts_and_misspellings(toxic_words):
    texts, labels = toxic_words
    model = toxicity.train(texts[:480], labels[:480])
    scores = model.scores(texts[480:])
    assert ((scores >= 0.5) == np.array(labels[480:], bool)).mean() > 0.95
    plain = ("mild river stone garden letter window paper silver yellow winter " * 6).encode()
    unseen = plain.replace(b"stone", b"rottten").replace(b"paper", b"wretchs")
    assert model.scores([unseen])[0] > model.scores([plain])[0] + 0.3


def test_toxicity_edge_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (3, 0), (7, 0), (12, 1), (12, 1), (None, 1), (9, None), (10, 7)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs.withColumn("score", F.lit("x")), model, ["doc_id"]).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert toxicity.score(no_docs, model, ["doc_id"]).count() == 0
    none = toxicity.fit(no_docs, labels.limit(0))
    assert all(r.predicted == 0 for r in toxicity.score(docs, none, ["doc_id"]).collect())


def test_network_gradients():
    rng = np.random.default_rng(1)
    layer = language.Layer(rng.normal(0, 0.4, (256, 9)), rng.normal(0, 0.4, (3, 9)))
    codes, weight = rng.integers(97, 100, (5, 4)), rng.normal(0, 1, (5, 4, 3))

    def loss():
        return float((layer.run(codes, range(5)).astype(np.float64) * weight).sum())

    trace = []
    layer.run(codes, range(5), trace)
    d_byte, d_state = layer.gradients(codes, trace, weight)
    for array, grad, at in ((layer.state, d_state, (1, 4)), (layer.state, d_state, (2, 8)), (layer.byte, d_byte, (98, 0)), (layer.byte, d_byte, (97, 7))):
        array[at] += 1e-2
        up = loss()
        array[at] -= 2e-2
        down = loss()
        array[at] += 1e-2
        assert abs((up - down) / 2e-2 - grad[at]) < 2e-2


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = held_out(F.col("doc_id"), 4, 2)
    model = language.fit(docs.filter(~out), sample_rows=150)
    got = language.label(docs.filter(out), model, ["doc_id", "lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97


def test_language_edge_rows(spark, docs, no_docs):
    model = language.fit(docs.withColumn("score", F.lit(1)))
    got = {(r.doc_id, r.n): r for r in language.label(docs.withColumn("n", F.coalesce(F.length("text"), F.lit(-1))), model, ["doc_id", "n"]).collect()}
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in ((4, -1), (5, 0), (6, 4)))
    assert all(r.lang_pred in {"en", "de", "fr", "und"} and 0 <= r.score <= 1 for r in got.values())
    assert got[(8, 8)].lang_pred != "und" and got[(9, 30_000)].lang_pred != "und"
    nothing = language.fit(no_docs)
    assert {r.lang_pred for r in language.label(docs, nothing, ["doc_id"]).collect()} == {"und"}
    assert language.label(no_docs, model, ["doc_id"]).count() == 0


def test_a_score_does_not_depend_on_the_texts_around():
    from millrace.llm import toxicity

    weight = np.random.default_rng(3).normal(size=1 << toxicity.BITS).astype(np.float32)
    model = toxicity.Model(weight, 0.25)
    values = [b"", b"toxic words here", b"one", b"", b"a calm sentence", b"toxic", b"12"]
    alone = [model.scores([v])[0] for v in values]
    assert np.allclose(model.scores(values), alone, atol=1e-9) and np.allclose(model.scores(values[::-1]), alone[::-1], atol=1e-9)
    assert alone[0] == alone[6] == 1 / (1 + np.exp(-0.25))


def plain_states(layer, codes, order):
    """One position after the other, one unit after the other."""
    hidden = layer.state.shape[0]
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    h, out = np.zeros(hidden), {}
    for t in order:
        x = layer.byte[codes[t]]
        u = [sum(h[i] * layer.state[i, j] for i in range(hidden)) for j in range(3 * hidden)]
        new = np.zeros(hidden)
        for j in range(hidden):
            z, r = sigmoid(x[j] + u[j]), sigmoid(x[hidden + j] + u[hidden + j])
            n = np.tanh(x[2 * hidden + j] + r * u[2 * hidden + j])
            new[j] = (1 - z) * n + z * h[j]
        h = out[t] = new
    return out


def test_document_probabilities_against_a_plain_network():
    rng = np.random.default_rng(5)
    layers = tuple(language.Layer(rng.normal(0, 0.5, (256, 9)).astype(np.float32), rng.normal(0, 0.5, (3, 9)).astype(np.float32)) for _ in range(2))
    model = language.Model(["a", "b", "c"], layers, rng.normal(0, 1, (6, 3)).astype(np.float32), rng.normal(0, 1, 3).astype(np.float32))
    for text in (b"Two words, and 12 more; " * 9, "Ünï cödé".encode(), b"x"):
        raw = language.letters(np.frombuffer(text + b" " * (-len(text) % language.STEPS), np.uint8))
        total = []
        for at in range(0, len(raw), language.STEPS):
            codes = raw[at : at + language.STEPS]
            ahead, back = plain_states(layers[0], codes, range(len(codes))), plain_states(layers[1], codes, range(len(codes) - 1, -1, -1))
            for t in np.flatnonzero(codes != 0x20):
                e = np.exp(ahead[t] @ model.out[:3] + back[t] @ model.out[3:] + model.bias)
                total.append(e / e.sum())
        assert np.allclose(model.documents([text])[0], np.mean(total, 0), atol=1e-4)


def test_a_language_of_long_documents_only_is_learned(spark):
    rng = np.random.default_rng(1)
    word = lambda letters, n: " ".join("".join(rng.choice(list(letters), 5)) for _ in range(n))
    rows = [(i, word("abcdefg", 60), "x") for i in range(60)] + [(100 + i, word("stuvwxyz", 5000), "y") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.labels == ["x", "y"]
    got = language.label(spark.createDataFrame([(1, word("abcdefg", 30)), (2, word("stuvwxyz", 30))], "doc_id long, text string"), model, ["doc_id"])
    assert {r.doc_id: r.lang_pred for r in got.collect()} == {1: "x", 2: "y"}


def test_the_sample_of_repeated_rows_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "train", lambda values, langs: seen.append(len(values)))
    language.fit(spark.range(5000).select(F.lit(1).alias("doc_id"), F.lit("the same text").alias("text"), F.lit("en").alias("lang")), sample_rows=5000)
    language.fit(spark.range(5000).select(F.lit(1).alias("doc_id"), F.lit("the same text").alias("text"), F.lit("en").alias("lang")), sample_rows=20)
    assert seen[0] == 5000 and seen[1] <= 40


def plain_score(model, text):
    """Every piece of every word by itself, its bucket's weight, the mean with the neutral pieces, and the logistic function."""
    lowered = "".join(c.lower() if c.isascii() and c.isalpha() or "À" <= c <= "Þ" and c != "×" else c if ord(c) > 127 else " " for c in text)
    total = count = 0
    for word in lowered.split(" "):
        padded = b" " + word.encode() + b" "
        for n in toxicity.LENGTHS:
            for i in range(len(padded) - n + 1 if word else 0):
                piece = padded[i : i + n]
                if not (i == 0 and i + n == len(padded)):
                    h = 0
                    for k, c in enumerate(piece):
                        h = (h * 0x01000193 + c + 1) % (1 << 32) if k else c + 1
                    total += float(model.weight[((h ^ (h >> 15)) * 0x9E3779B1 % (1 << 32)) >> (32 - toxicity.BITS)])
                    count += 1
    return 1 / (1 + np.exp(-(total / (count + toxicity.NEUTRAL) + model.bias)))


def test_scores_against_a_plain_average(toxic_words):
    weight = np.random.default_rng(8).normal(size=toxicity.BUCKETS).astype(np.float32) * 20
    model = toxicity.Model(weight, -0.3)
    texts = ["", "a", "ab c", "One, TWO; three!", "Ünïcode ÀÉ words 12 3", "tabs\tand\nlines " * 30, "x" * 300, "日本語 text"]
    got = model.scores([t.encode() for t in texts])
    assert np.allclose(got, [plain_score(model, t) for t in texts], atol=1e-5)
