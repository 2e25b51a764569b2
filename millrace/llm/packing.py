"""Packing of tokenized documents into fixed sequences, online and in bounded space.

Every task keeps at most ``OPEN`` windows of ``CAPACITY`` tokens open. A document's whole windows
go out as they are; what is left of it goes into the open window it fits best. If it fits none
and all windows are open, the fullest is sent out, topped up with the head of the piece where the
gap is worth a cut. At the end of a task its open windows are merged to one that is not full; these
last windows, one of each task, are merged once more in groups of ``GROUP`` tasks.

Space is bounded in every step, and padding is left only in gaps under ``WORTH`` tokens and in one
sequence per group. No step sees more than a task's own windows or a group's last ones.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.registry import query
from millrace.llm.texts import as_bytes, tidy
from millrace.session import scratch
from millrace.tables import table

CAPACITY = 1024
OPEN = 64
WORTH = 16
GROUP = 256
END = 0  # the id behind each document
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")  # the same vocabulary for the other library
CHUNK = 1 << 18
LONG_WORD = 3000

SCHEMA = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


class Encoder:
    """Ids of texts in the byte-level vocabulary.

    The rank file's library does the work. Texts with the vocabulary's special token or with very
    long words go to the library of the JSON file; both give the same ids.
    """

    def __init__(self, ranks: str, vocabulary: str) -> None:
        import tiktoken

        with open(ranks, "rb") as file:
            found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=found, special_tokens={})
        self.vocabulary, self.slow = vocabulary, None

    def __call__(self, raw: bytes) -> np.ndarray:
        text = raw.decode("utf-8", "replace")
        if "<|endoftext|>" in text or len(raw) > LONG_WORD and re.search(rf"\S{{{LONG_WORD}}}|\s{{{LONG_WORD}}}", text):
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.vocabulary)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.concatenate([self.fast.encode_to_numpy(part) for part in chunks(text)]) if text else np.empty(0, np.uint32)


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Parts of a text, cut where every tokenization is cut: between a character and a space behind it."""
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


class Piece:
    __slots__ = ("key", "start", "ids", "doc_tokens")

    def __init__(self, key, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        self.key, self.start, self.ids, self.doc_tokens = key, start, ids, doc_tokens

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.key, self.start, self.ids[:n], self.doc_tokens), Piece(self.key, self.start + n, self.ids[n:], self.doc_tokens)


class Packer:
    """Best fit over a fixed number of open windows. Full windows go to ``send`` as lists of pieces."""

    def __init__(self, send: Callable[[list[Piece]], None], capacity: int = CAPACITY, most: int = OPEN, worth: int = WORTH) -> None:
        self.send, self.capacity, self.most, self.worth = send, capacity, most, worth
        self.rooms: list[tuple[int, int]] = []  # (room, window), sorted
        self.windows: dict[int, list[Piece]] = {}
        self.next = 0

    def document(self, key, ids: np.ndarray) -> None:
        n, whole = len(ids), len(ids) // self.capacity * self.capacity
        for at in range(0, whole, self.capacity):
            self.send([Piece(key, at, ids[at : at + self.capacity], n)])
        if whole < n:
            self.place(Piece(key, whole, ids[whole:].copy(), n))

    def place(self, piece: Piece) -> None:
        at = bisect.bisect_left(self.rooms, (len(piece.ids), -1))
        if at == len(self.rooms) and len(self.rooms) == self.most:
            room, window = self.rooms.pop(0)
            if room >= self.worth:
                head, piece = piece.cut(room)
                self.windows[window].append(head)
            self.send(self.windows.pop(window))
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            room, window = self.capacity, self.next
            self.windows[window] = []
            self.next += 1
        self.windows[window].append(piece)
        if room == len(piece.ids):
            self.send(self.windows.pop(window))
        else:
            bisect.insort(self.rooms, (room - len(piece.ids), window))

    def merge(self) -> list[Piece]:
        """Fill the fullest windows from the emptiest until one is left; returns it."""
        while len(self.rooms) > 1:
            room, window = self.rooms.pop(0)
            _, source = self.rooms.pop()
            pieces, left = self.windows[window], self.windows[source]
            while room and left:
                piece = left.pop()
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    left.append(rest)
                pieces.append(piece)
                room -= len(piece.ids)
            if room:
                bisect.insort(self.rooms, (room, window))
                del self.windows[source]
            else:
                self.send(self.windows.pop(window))
                if left:
                    bisect.insort(self.rooms, (self.capacity - sum(len(p.ids) for p in left), source))
                else:
                    del self.windows[source]
        last = self.windows.pop(self.rooms.pop()[1]) if self.rooms else []
        return last


class Rows:
    """Collects packed windows as Arrow columns."""

    def __init__(self, keys: pa.Schema, first: int, with_ids: bool) -> None:
        self.keys, self.with_ids, self.next = keys, with_ids, first
        self.rows: list[tuple] = []

    def add(self, pieces: list[Piece], ids: bool = False) -> None:
        offset = 0
        for p in pieces:
            raw = p.ids.astype("<u4").tobytes()
            self.rows.append((p.key, p.start, len(p.ids), zlib.crc32(raw), p.doc_tokens, self.next, offset, raw if ids or self.with_ids else None))
            offset += len(p.ids)
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        key, *rest = zip(*self.rows)
        arrays = [pa.array([k[i] for k in key], f.type) for i, f in enumerate(self.keys)]
        arrays += [pa.array(x, pa.int64()) for x in rest[:-1]] + [pa.array(rest[-1], pa.binary())]
        self.rows = []
        names = [*self.keys.names, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        return pa.RecordBatch.from_arrays(arrays, names)


def pack(docs: DataFrame, keep: list[str], capacity: int = CAPACITY, with_ids: bool = False, ranks: str = RANKS, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: columns ``keep`` of its document, then the columns of ``SCHEMA``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers if ``with_ids`` is set, else
    null. A null or empty text is one piece, the end id alone. Repeated rows are packed one by one.
    ``docs`` should be a scan, or a written table, so that a task that runs again sees the same rows.
    """
    spark = docs.sparkSession
    rows = docs.select(*keep, as_bytes(F.col("text")).alias("__bytes"))
    keys = rows.drop("__bytes").schema
    schema = spark.createDataFrame([], SCHEMA).schema
    schema = type(keys)([*keys.fields, *schema.fields])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, packer = Encoder(ranks, vocabulary), None, None
        for batch in stream:
            if out is None:
                out = Rows(pa.schema(list(batch.schema)[:-1]), TaskContext.get().partitionId() << 32, with_ids)
                packer = Packer(out.add, capacity)
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns - 1)]
            for i, raw in enumerate(batch.column(batch.num_columns - 1)):
                ids = np.concatenate([encode(raw.as_py()), np.array([END], np.uint32)])
                packer.document(tuple(c[i] for c in columns), ids)
                if len(out.rows) >= 20_000:
                    yield out.batch()
            if out.rows:
                yield out.batch()
        if out is not None:
            last = packer.merge()
            if out.rows:
                yield out.batch()
            if last:
                # Marked by a negative number until it is merged with other tasks' last windows.
                out.next = -1 - TaskContext.get().partitionId()
                out.add(last, ids=True)
                yield out.batch()

    def merged(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, out, packer = None, None, None

        def finish() -> Iterator[pa.RecordBatch]:
            if packer is not None:
                last = packer.merge()
                if last:
                    out.add(last)
                if out.rows:
                    yield out.batch()

        n = len(keys)
        for batch in stream:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for row in zip(*columns):
                start, _, _, tokens, sequence, _, raw = row[n : n + 7]
                if (-1 - sequence) // GROUP != group:
                    yield from finish()
                    group = (-1 - sequence) // GROUP
                    out = Rows(pa.schema(list(batch.schema)[:n]), (1 << 62) + (group << 32), with_ids)
                    packer = Packer(out.add, capacity, most=GROUP)
                packer.place(Piece(row[:n], start, np.frombuffer(raw, "<u4"), tokens))
        yield from finish()

    path = scratch(spark, "packed")
    rows.mapInArrow(tidy(batches), schema).write.parquet(path)
    packed = spark.read.schema(schema).parquet(path)
    last = packed.filter("sequence_id < 0")
    group = F.floor((-1 - F.col("sequence_id")) / GROUP)
    last = last.repartition(group).sortWithinPartitions(F.desc("sequence_id"), "offset")
    return packed.filter("sequence_id >= 0").unionByName(last.mapInArrow(tidy(merged), schema))


@query("op5_packing")
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), ["doc_id"]).drop("ids")
