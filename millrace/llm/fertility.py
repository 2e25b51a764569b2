"""Quality rules on top of tokenizer fertility.

A public vocabulary with byte fallback measures each text: characters per token, the share of
byte tokens, and the entropy of its tokens. Text that the vocabulary does not fit (symbol soup,
shouting, encoded data), or that repeats itself, leaves the band that texts of its language and
length keep to. Bands are quartiles over all documents of a language (of a script, where no
language is given) and octave of token count, widened by ``REACH`` times the distance of the
quartiles, and never narrower than ``LEAST``. Where these are few, the band is that of the language,
then of the text's script, then of all documents, so that every document has one.

A text is measured whole, a bounded piece at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.registry import query
from millrace.llm.texts import as_bytes, pieces, table_of, tidy
from millrace.session import scratch
from millrace.tables import table

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
PIECE_BYTES = 1 << 16
WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
REACH = 2.0
LEAST = {"chars_per_token": 0.2, "byte_share": 0.05, "entropy": 0.03}
FEWEST = 30  # documents that a band is taken from; below, that of the language, the script, then all documents
BROADCAST_ROWS = 10_000
#: First and last code point of the larger scripts.
SCRIPTS = (
    ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF), ("indic", 0x900, 0xDFF),
    ("thai", 0xE00, 0xE7F), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)


def word_facts(raw: bytes, text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text.

    Splitting bytes splits at exactly the six ASCII white space characters.
    """
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(text.count(chr(c)) for c in WHITE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if n >= 6:
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
        if len(seen) < n:
            # A window's number comes from its first four words' number and its last word.
            code = ids
            for k in range(1, 5):
                _, code = np.unique(code[: n - k] * (len(seen) + 1) + ids[k:], return_inverse=True)
            again = np.bincount(code)[code] >= 2
            if again.any():
                mark = np.zeros(n + 1, np.int64)
                at = np.flatnonzero(again)
                np.add.at(mark, at, 1)
                np.add.at(mark, at + 5, -1)
                repeated = int((np.cumsum(mark[:n]) > 0).sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def script_of(text: str) -> str:
    """The script most of the letters beyond ASCII are in, latin if these are a minority."""
    if text.isascii():
        return "latin"
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    found = {name: int(((codes >= a) & (codes <= b)).sum()) for name, a, b in SCRIPTS}
    name = max(found, key=found.get)
    return name if 2 * found[name] > sum(c.isalpha() for c in text) else "latin"


class Fertility:
    """Measures texts with a SentencePiece vocabulary; bytes are its ids ``first`` to ``last``."""

    def __init__(self, vocabulary: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        size = self.model.get_piece_size()
        self.size, self.is_byte = size, np.array([self.model.is_byte(i) for i in range(size)])

    def measure(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, byte tokens and entropy (over its largest possible value) of each text."""
        tokens, byte, entropy = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), np.ones(len(texts))
        counts: dict[int, np.ndarray] = {}

        def done(i: int) -> None:
            times = counts.pop(i)
            tokens[i], byte[i] = times.sum(), times[self.is_byte].sum()
            share = times[times > 0] / max(1, tokens[i])
            most = np.log2(min(max(2, tokens[i]), self.size))
            entropy[i] = min(1.0, max(0.0, -(share * np.log2(share)).sum() / most)) if tokens[i] > 1 else 1.0

        last = -1
        for i, piece in pieces(texts, PIECE_BYTES):
            if last >= 0 and i != last:
                done(last)
            ids = self.model.encode(piece.decode("utf-8", "replace"), num_threads=1)
            times = np.bincount(np.array(ids, np.int64), minlength=self.size)
            counts[i] = counts[i] + times if i in counts else times
            last = i
        if last >= 0:
            done(last)
        return tokens, byte, entropy


def measure(docs: DataFrame, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """Columns ``keep`` of every document, its base facts, its script and its fertility."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = Fertility(vocabulary)
        for batch in stream:
            raw = batch.column(batch.num_columns - 1).to_pylist()
            texts = [b.decode("utf-8", "replace") for b in raw]
            facts = np.array([word_facts(b, t) for b, t in zip(raw, texts)], np.int64).reshape(-1, 5)
            tokens, byte, entropy = fertility.measure(raw)
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            yield table_of(
                batch, keep, **{n: pa.array(facts[:, k]) for k, n in enumerate(names)}, script=pa.array([script_of(t) for t in texts]),
                n_tokens=pa.array(tokens), chars_per_token=pa.array(facts[:, 1] / np.maximum(tokens, 1)),
                byte_share=pa.array(byte / np.maximum(tokens, 1)), entropy=pa.array(entropy),
            )

    rows = docs.select(*keep, as_bytes(F.col("text")).alias("__bytes"))
    schema = rows.drop("__bytes").schema
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
        schema = schema.add(name, "long")
    schema = schema.add("script", "string").add("n_tokens", "long")
    for name in LEAST:
        schema = schema.add(name, "double")
    return rows.mapInArrow(tidy(batches), schema)


def judge(measured: DataFrame, reach: float = REACH) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to what ``measure`` returns, with the bands of the rows themselves.

    ``measured`` should be a written table: it is read for the bands and for the verdicts. A
    language with under ``FEWEST`` documents of a length takes its band from all its lengths, one
    with fewer documents than that from all documents in the text's script, and a script with fewer
    than that from all documents, however few. Documents that fail the base rules make no band.
    """
    group = F.coalesce(F.col("lang"), F.concat(F.lit("script:"), "script"))
    rows = measured.withColumns({"__group": group, "__octave": F.length(F.bin("n_tokens"))})
    rows = rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    quartiles = [F.percentile_approx(n, [0.25, 0.5, 0.75], 1000).alias(n) for n in LEAST]
    sound = rows.filter(~F.col("base_failed"))
    levels = {"__narrow": ["__group", "__octave"], "__wide": ["__group"], "__script": ["script"]}
    joined, bands = rows, []
    for level, keys in levels.items():
        band = sound.groupBy(*keys).agg(*quartiles, F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= FEWEST)
        joined = joined.join(_small(band.select(*keys, F.struct(*LEAST).alias(level))), keys, "left")
        bands.append(level)
    joined = joined.crossJoin(F.broadcast(sound.agg(*quartiles).select(F.struct(*LEAST).alias("__any"))))
    joined = joined.withColumn("__band", F.coalesce(*bands, "__any"))
    inside = F.lit(True)
    for name, least in LEAST.items():
        q = F.col("__band")[name]
        room = F.greatest(reach * (q[2] - q[0]), F.lit(least))
        low, high = F.col(name) >= q[0] - room, F.col(name) <= q[2] + room
        inside = inside & {"byte_share": high, "entropy": low}.get(name, low & high)
    joined = joined.withColumn("kept", ~F.col("base_failed") & inside)
    return joined.select(*measured.columns, "base_failed", "kept")


def _small(bands: DataFrame) -> DataFrame:
    """Broadcast, if there are at most ``BROADCAST_ROWS`` bands."""
    spark, path = bands.sparkSession, scratch(bands.sparkSession, "bands")
    bands.write.parquet(path)
    bands = spark.read.schema(bands.schema).parquet(path)
    return F.broadcast(bands) if bands.count() <= BROADCAST_ROWS else bands


def rate(docs: DataFrame, keep: list[str] = ["doc_id"], vocabulary: str = VOCABULARY) -> DataFrame:
    """Measure and judge documents that have columns ``text`` and ``lang``.

    Null and empty texts have no words and fail the base rules. A null language is replaced by the
    text's script. Repeated rows are judged one by one. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = scratch(spark, "fertility")
    measured = measure(docs, list(dict.fromkeys([*keep, "lang"])), vocabulary)
    measured.write.parquet(path)
    return judge(spark.read.schema(measured.schema).parquet(path))


@query("op9_fertility")
def op9_fertility(spark: SparkSession, folder: str) -> DataFrame:
    return rate(table(spark, folder, "documents")).drop("lang")
