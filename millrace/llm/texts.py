"""Texts in Arrow batches as bytes, cut into blocks that numpy handles in bounded memory."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
SPACE = 0x20


def as_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id is held out of nothing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


_WHITE = [bytes([c]) for c in b" \t\n\x0b\x0c\r"]


def pieces(values: list[bytes], limit: int = BLOCK_BYTES, hard: bool = True) -> Iterator[tuple[int, bytes]]:
    """(index of the text, bytes): texts over the limit are cut behind white space.

    Where there is none, a text is cut at the limit if ``hard`` is set, else behind the next there is.
    """
    for i, value in enumerate(values):
        start = 0
        while len(value) - start > limit:
            cut = max(value.rfind(c, start, start + limit) for c in _WHITE) + 1
            if cut <= start:
                after = [k for c in _WHITE if (k := value.find(c, start + limit)) >= 0]
                cut = start + limit if hard else min(after) + 1 if after else len(value)
            yield i, value[start:cut]
            start = cut
        if start < len(value) or not start:
            yield i, value[start:]


def blocks(values: list[bytes], limit: int = BLOCK_BYTES, hard: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, start of each piece, its text's index): pieces joined by one space, also at both ends."""
    part: list[bytes] = []
    owner: list[int] = []
    size = 0

    def joined():
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) + 1
        return np.frombuffer(b" " + b" ".join(part) + b" ", np.uint8), starts, np.array(owner)

    for i, piece in pieces(values, limit, hard):
        if part and size + len(piece) > limit:
            yield joined()
            part, owner, size = [], [], 0
        part.append(piece)
        owner.append(i)
        size += len(piece)
    if part:
        yield joined()


#: Lower case of ASCII letters; everything but letters and bytes of longer characters becomes a space.
_LETTERS = np.full(256, SPACE, np.uint8)
_LETTERS[0x61:0x7B] = _LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def letters(raw: np.ndarray) -> np.ndarray:
    """Lower-cased letters (ASCII and Latin-1), spaces for ASCII characters that are no letters."""
    out = _LETTERS[raw]
    after = np.flatnonzero(out[:-1] == 0xC3) + 1
    upper = after[(out[after] >= 0x80) & (out[after] <= 0x9E) & (out[after] != 0x97)]
    out[upper] |= 0x20
    return out


def by_text(totals: np.ndarray, starts: np.ndarray, owner: np.ndarray, values: np.ndarray) -> None:
    """Add the sum of ``values`` over each piece, from the space before it on, to its text's total."""
    np.add.at(totals, owner, np.add.reduceat(values, starts - 1))


def slices(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that few texts are Python objects at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def table_of(batch: pa.RecordBatch, keep: list[str], **columns: pa.Array) -> pa.RecordBatch:
    """The named columns of a batch and new ones behind them."""
    arrays = [batch.column(batch.schema.get_field_index(n)) for n in keep]
    return pa.RecordBatch.from_arrays([*arrays, *columns.values()], [*keep, *columns])


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(task: Task) -> Task:
    """A task that gives the memory it has freed back to the system: its worker stays, idle, beside later stages."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(stream)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:  # not this C library
            pass

    return run
