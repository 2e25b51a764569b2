"""Toxicity of documents: a bag of subword embeddings, averaged, under a linear softmax.

A text is the bag of the 3 to 5 byte long pieces of its lower-cased words, word ends included.
Each piece is hashed to one of ``BUCKETS`` embeddings; a text is the mean of its pieces'
embeddings, and a softmax over two linear outputs gives the score. Embeddings and output weights
are trained together in numpy. A misspelled or inflected word shares most of its pieces with the
word seen in training.

As everything behind the lookup is linear, one number per bucket is enough for scoring: the
broadcast model is 1 MB whatever it was trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.registry import query
from millrace.llm.texts import SPACE, as_bytes, blocks, by_text, held_out, letters, table_of, tidy
from millrace.tables import table

LENGTHS = (3, 4, 5)
BITS = 18
BUCKETS = 1 << BITS
SAMPLE_ROWS = {0: 6000, 1: 3000}  # of each label, at most
SAMPLE_CHARS = 20_000  # longer documents are scored, but not learned from
NEUTRAL = 80  # pieces without meaning added to every bag, so that a few pieces alone prove little
STEPS = 700  # training steps at least
TOXIC_SHARE = 0.25  # weight of the toxic texts among all, at least
SEEN = 4  # pieces in fewer training texts have no meaning


def piece_buckets(raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the bucket of the piece that starts at each byte, and whether it is within one word.

    A piece may begin or end with the space at a word's edge, but has none inside.
    """
    a = letters(raw)
    space = np.concatenate(([0], np.cumsum(a == SPACE, dtype=np.int32)))
    code = a.astype(np.uint32) + np.uint32(1)
    top = max(LENGTHS)
    h = code.copy()
    for n in range(2, top + 1):
        h = h[:-1] * np.uint32(0x01000193) + code[n - 1 :]
        if n in LENGTHS:
            m = len(h)
            inner = space[n - 1 : n - 1 + m] == space[1 : 1 + m]
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)
            yield mixed >> np.uint32(32 - BITS), inner & ~((a[:m] == SPACE) & (a[n - 1 : n - 1 + m] == SPACE))


@dataclass
class Model:
    weight: np.ndarray  # each bucket's part of the difference between the two outputs
    bias: float

    def scores(self, values: list[bytes]) -> np.ndarray:
        total, count = np.zeros(len(values)), np.zeros(len(values))
        for raw, starts, owner in blocks(values):
            score, number = np.zeros(len(raw), np.float32), np.zeros(len(raw), np.float32)
            for bucket, ok in piece_buckets(raw):
                score[: len(bucket)] += np.where(ok, self.weight[bucket], np.float32(0))
                number[: len(bucket)] += ok
            by_text(total, starts, owner, score.astype(np.float64))
            by_text(count, starts, owner, number.astype(np.float64))
        return 1 / (1 + np.exp(-np.clip(total / (count + NEUTRAL) + self.bias, -500, 500)))


def train(values: list[bytes], labels: list[int], dim: int = 8, epochs: int = 10, rate: float = 8.0, seed: int = 5) -> Model:
    """Train embeddings and output weights together, by minibatches with Adagrad steps.

    With one label only, or without rows, the model answers with the share of toxic rows.
    """
    y = np.array(labels, np.int64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS, np.float32), 20.0 * (2 * y.mean() - 1) if len(y) else -20.0)
    ids, parts = [], []
    for value in values:
        found = [b[ok] for raw, _, _ in blocks([value]) for b, ok in piece_buckets(raw)]
        unique, times = np.unique(np.concatenate(found), return_counts=True)
        ids.append(unique.astype(np.int32))
        parts.append((times / (times.sum() + NEUTRAL)).astype(np.float32))
    known = np.bincount(np.concatenate(ids), minlength=BUCKETS) >= SEEN
    for i, b in enumerate(ids):
        ids[i], parts[i] = b[known[b]], parts[i][known[b]]
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, dim)).astype(np.float32)
    out = rng.normal(0, 0.3, (dim, 2)).astype(np.float32)
    bias = np.log(np.maximum(np.bincount(y, minlength=2), 1) / len(y)).astype(np.float32)
    emb_sq, out_sq, bias_sq = np.full((BUCKETS, dim), 1e-7, np.float32), np.full(out.shape, 1e-8), np.full(2, 1e-8)
    rows = np.array([i for i in range(len(y)) if len(ids[i])], np.int64)
    heavier = max(1.0, TOXIC_SHARE / (1 - TOXIC_SHARE) * (1 - y.mean()) / y.mean())
    batches = -(-len(rows) // min(128, max(8, len(rows) // 32)))
    epochs = max(epochs, -(-STEPS // batches)) if batches else 0
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for batch in np.array_split(rng.permutation(rows), batches):
            index, weight = np.concatenate([ids[i] for i in batch]), np.concatenate([parts[i] for i in batch])
            lengths = np.array([len(ids[i]) for i in batch])
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            mean = np.add.reduceat(emb[index] * weight[:, None], starts, axis=0)
            logits = mean @ out + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), y[batch]] -= 1
            p *= np.where(y[batch] == 1, heavier, 1)[:, None] / len(batch)
            g_out, g_bias, g_mean = mean.T @ p, p.sum(0), p @ out.T
            touched, where = np.unique(index, return_inverse=True)
            spread = np.repeat(g_mean, lengths, axis=0) * weight[:, None]
            g_emb = np.stack([np.bincount(where, spread[:, k], len(touched)) for k in range(dim)], 1).astype(np.float32)
            emb_sq[touched] += g_emb**2
            emb[touched] -= step * g_emb / np.sqrt(emb_sq[touched])
            out_sq += g_out**2
            out -= (0.05 * step * g_out / np.sqrt(out_sq)).astype(np.float32)
            bias_sq += g_bias**2
            bias -= (0.05 * step * g_bias / np.sqrt(bias_sq)).astype(np.float32)
    return Model(np.where(known, emb @ (out[:, 1] - out[:, 0]), 0).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: dict[int, int] = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Train on at most so many labelled documents of each label as ``sample_rows`` says, chosen by a hash of the id.

    Labels other than 0 and 1 and documents without text or id are left out. Ids are chosen among
    the labels alone; only the chosen documents' texts reach the driver.
    """
    chosen = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    first = [
        chosen.filter(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for v, n in sample_rows.items()
    ]
    ids = F.broadcast(first[0].unionAll(first[1]).select("doc_id", "toxic"))
    texts = docs.filter(F.length("text") <= sample_chars).select("doc_id", as_bytes(F.col("text")).alias("__bytes"))
    rows = texts.join(ids, "doc_id").select("doc_id", "__bytes", "toxic").limit(2 * sum(sample_rows.values())).collect()
    rows.sort(key=lambda r: (r.doc_id, r["__bytes"]))
    return train([bytes(r["__bytes"]) for r in rows], [r.toxic for r in rows])


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every document with ``score`` (0 to 1) and ``predicted`` (score at least 0.5).

    Null and empty texts, and texts without letters, get the score of the model's bias alone. Texts
    of any length are scored whole, a block at a time. Repeated rows are scored one by one.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.weight, model.bias))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in stream:
            s = model.scores(batch.column(batch.num_columns - 1).to_pylist())
            yield table_of(batch, keep, score=pa.array(s), predicted=pa.array((s >= 0.5).astype(np.int32)))

    rows = docs.select(*keep, as_bytes(F.col("text")).alias("__bytes"))
    schema = rows.drop("__bytes").schema.add("score", "double").add("predicted", "integer")
    return rows.mapInArrow(tidy(batches), schema)


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    learned = table(spark, folder, "labels").filter(~held_out(F.col("doc_id"), 5, 0))
    scored = score(docs, fit(docs, learned), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")
