"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are lower-cased, every ASCII character that is no letter becomes a space, and the bytes are
laid out in windows of ``STEPS``. Two gated recurrent layers, one in either direction, read each
window; a softmax over their states labels every position. A document's probabilities are the
means over its letter positions, so every byte of a text of any length counts.

The network is trained in numpy by backpropagation through time on windows drawn from a bounded
sample of labelled documents. It has a few thousand weights, so it is broadcast whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.registry import query
from millrace.llm.texts import SPACE, as_bytes, held_out, letters, pieces, slices, table_of, tidy
from millrace.tables import table

STEPS = 64  # bytes of a window
HIDDEN = 12
SAMPLE_ROWS = 1500  # labelled documents of each language learned from, about
SAMPLE_CHARS = 20_000  # learned from a document: a longer one gives a stretch from a place of its hash
MOST_LANGUAGES = 500  # the ones with most documents; a bound for what comes to the driver
GROUP_BYTES = 1 << 17  # bytes that go through the network together
UNDETERMINED = "und"


@dataclass
class Layer:
    """Gates z (keep), r (reset) and candidate n: input rows by byte, recurrent weights."""

    byte: np.ndarray  # 256 x 3 hidden, biases included
    state: np.ndarray  # hidden x 3 hidden

    def run(self, codes: np.ndarray, order: range, trace: list | None = None) -> np.ndarray:
        """States of all positions, for codes of shape (steps, windows)."""
        hidden = self.state.shape[0]
        h = np.zeros((codes.shape[1], hidden), np.float32)
        out = np.empty((*codes.shape, hidden), np.float32)
        for t in order:
            x, u = self.byte[codes[t]], h @ self.state
            gates = np.tanh((x[:, : 2 * hidden] + u[:, : 2 * hidden]) * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)
            z, r, un = gates[:, :hidden], gates[:, hidden:], u[:, 2 * hidden :]
            n = np.tanh(x[:, 2 * hidden :] + r * un)
            if trace is not None:
                trace.append((t, h, z, r, un, n))
            h = n + z * (h - n)
            out[t] = h
        return out

    def gradients(self, codes: np.ndarray, trace: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backpropagation through time: gradients of ``byte`` and ``state``."""
        d_byte, d_state = np.zeros_like(self.byte), np.zeros_like(self.state)
        d_h = np.zeros(d_out.shape[1:], np.float32)
        for t, h, z, r, un, n in reversed(trace):
            d_h = d_h + d_out[t]
            a_n = d_h * (1 - z) * (1 - n * n)
            a_z = d_h * (h - n) * z * (1 - z)
            a_r = a_n * un * r * (1 - r)
            np.add.at(d_byte, codes[t], np.concatenate([a_z, a_r, a_n], 1))
            a_u = np.concatenate([a_z, a_r, a_n * r], 1)
            d_state += h.T @ a_u
            d_h = d_h * z + a_u @ self.state.T
        return d_byte, d_state


@dataclass
class Model:
    labels: list[str]
    layers: tuple[Layer, Layer]
    out: np.ndarray  # 2 hidden x labels
    bias: np.ndarray

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Probabilities of each label at each position, for codes of shape (steps, windows)."""
        ahead, back = range(len(codes)), range(len(codes) - 1, -1, -1)
        hidden = self.layers[0].state.shape[0]
        logits = self.layers[0].run(codes, ahead) @ self.out[:hidden] + self.layers[1].run(codes, back) @ self.out[hidden:] + self.bias
        logits -= logits.max(2, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(2, keepdims=True)

    def documents(self, values: list[bytes]) -> np.ndarray:
        """Mean probabilities over the letters of each text; equal ones without letters."""
        total, count = np.zeros((len(values), len(self.labels))), np.zeros(len(values))
        for codes, owner in windows(values):
            letter = (codes != SPACE)
            p = self.positions(codes) * letter[:, :, None]
            np.add.at(total, owner, p.sum(0))
            np.add.at(count, owner, letter.sum(0))
        return np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], 1 / max(1, len(self.labels)))


def windows(values: list[bytes], steps: int = STEPS, limit: int = GROUP_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes of shape (steps, windows), the text each window belongs to), in groups of bounded size."""
    part: list[tuple[int, bytes]] = []
    size = 0

    def laid_out():
        n = np.array([-(-len(b) // steps) for _, b in part])
        flat = np.full(int(n.sum()) * steps, SPACE, np.uint8)
        at = 0
        for (_, b), k in zip(part, n):
            flat[at : at + len(b)] = np.frombuffer(b, np.uint8)
            at += int(k) * steps
        return np.ascontiguousarray(letters(flat).reshape(-1, steps).T), np.repeat([i for i, _ in part], n)

    for i, piece in pieces(values, limit):
        if not piece:
            continue
        if part and size + len(piece) > limit:
            yield laid_out()
            part, size = [], 0
        part.append((i, piece))
        size += len(piece)
    if part:
        yield laid_out()


def train(values: list[bytes], langs: list[str], hidden: int = HIDDEN, rounds: int = 700, batch: int = 192, rate: float = 0.01, seed: int = 3) -> Model:
    """Train on random windows, each language drawn equally often, with Adam steps."""
    labels = sorted(set(langs))
    k = len(labels)
    rng = np.random.default_rng(seed)
    layers = tuple(
        Layer(rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32), rng.normal(0, 0.5 / hidden**0.5, (hidden, 3 * hidden)).astype(np.float32))
        for _ in range(2)
    )
    model = Model(labels, layers, rng.normal(0, 0.3, (2 * hidden, k)).astype(np.float32), np.zeros(k, np.float32))
    if k < 2:
        return model
    by_label: list[list[np.ndarray]] = [[] for _ in labels]
    for value, lang in zip(values, langs):
        for codes, _ in windows([value]):
            by_label[labels.index(lang)].append(codes.T)
    pools = [np.concatenate(x) if x else np.empty((0, STEPS), np.uint8) for x in by_label]
    pools = [p[(p != SPACE).any(1)] for p in pools]
    usable = np.array([i for i, p in enumerate(pools) if len(p)])
    weights = [layers[0].byte, layers[0].state, layers[1].byte, layers[1].state, model.out, model.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, rounds + 1 if len(usable) else 1):
        y = rng.choice(usable, batch)
        codes = np.stack([pools[i][rng.integers(len(pools[i]))] for i in y], 1)
        traces: tuple[list, list] = ([], [])
        states = (layers[0].run(codes, range(STEPS), traces[0]), layers[1].run(codes, range(STEPS - 1, -1, -1), traces[1]))
        logits = states[0] @ model.out[:hidden] + states[1] @ model.out[hidden:] + model.bias
        p = np.exp(logits - logits.max(2, keepdims=True))
        p /= p.sum(2, keepdims=True)
        p[:, np.arange(batch), y] -= 1
        p *= (codes != SPACE)[:, :, None] / np.float32(max(1, int((codes != SPACE).sum())))
        grads = []
        for layer, trace, half in zip(layers, traces, (model.out[:hidden], model.out[hidden:])):
            grads += layer.gradients(codes, trace, p @ half.T)
        flat = p.reshape(-1, k)
        grads += [np.concatenate([s.reshape(-1, hidden).T @ flat for s in states]), flat.sum(0)]
        scale = min(1.0, 1 / (1e-9 + float(np.sqrt(sum((g * g).sum() for g in grads)))))
        now = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
        for w, g, m, v in zip(weights, grads, first, second):
            g = g * np.float32(scale)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return model


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Train on about ``sample_rows`` documents of each language, chosen by a hash of text and id.

    At most twice as many of a language, of ``MOST_LANGUAGES`` languages at most, come to the driver. Documents
    without text or language are left out.
    """
    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("__n")).orderBy(F.desc("__n"), "lang").limit(MOST_LANGUAGES)
    hashed = F.xxhash64("doc_id", F.length("text"))
    order = F.pmod(hashed, F.lit(1_000_003))
    share = F.lit(1_000_003.0 * sample_rows) / F.col("__n")
    start = F.pmod(hashed, F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1) + 1
    part = F.col("text").substr(start.cast("int"), F.lit(sample_chars))
    some = rows.join(F.broadcast(counts), "lang").filter(order < share).select("doc_id", "lang", order.alias("__order"), as_bytes(part).alias("__bytes"))
    # Rows alike in id and length share their hash; the rank bounds them too.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("__order", "doc_id"))
    chosen = some.withColumn("__place", place).filter(F.col("__place") <= 2 * sample_rows)
    sample = sorted((r.lang, r.doc_id is not None, r.doc_id or 0, bytes(r["__bytes"])) for r in chosen.collect())
    return train([r[3] for r in sample], [r[0] for r in sample])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def label(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every document with ``lang_pred`` and ``score``, its mean probability.

    A null text or one without a letter gets ``und`` and 0, as does every text if no language was
    learned. Ties go to the first label in alphabetical order. Repeated rows are labelled one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.labels, [(x.byte, x.state) for x in model.layers], model.out, model.bias))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, layers, *rest = shared.value
        model = Model(labels, tuple(Layer(*x) for x in layers), *rest)
        for batch in chain.from_iterable(map(slices, stream)):
            n = batch.num_columns
            known = np.array(batch.column(n - 2).to_pylist(), bool) & bool(model.labels)
            values = [b if ok else b"" for b, ok in zip(batch.column(n - 1).to_pylist(), known)]
            p = model.documents(values) if model.labels else np.zeros((len(values), 1))
            best = p.argmax(1)
            lang = [model.labels[i] if ok else UNDETERMINED for i, ok in zip(best, known)]
            score = np.where(known, p[np.arange(len(best)), best], 0.0)
            yield table_of(batch, keep, lang_pred=pa.array(lang, pa.string()), score=pa.array(np.minimum(score, 1.0)))

    rows = docs.select(*keep, has_letter(F.col("text")).alias("__letter"), as_bytes(F.col("text")).alias("__bytes"))
    schema = rows.drop("__bytes", "__letter").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(tidy(batches), schema)


@query("op2_language")
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    labelled = label(docs, fit(docs.filter(~out)), ["doc_id"])
    return labelled.select("doc_id", out.alias("held_out"), "lang_pred", "score")
