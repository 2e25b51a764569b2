"""Removal of byte strings that occur twice, by suffix sorting in two stages.

Every window of ``LENGTH`` bytes that has an equal elsewhere is removed. A window's anchor is the
leftmost of its ``GRAM``-byte pieces with the smallest hash; equal windows have equal anchors at
equal places, so only windows with one anchor hash need comparing. Neighbouring windows with the
same anchor form a stretch.

1. Stretches that are equal as a whole are found by their hashes, within a batch first, so that a
   stretch with very many copies sends one row from each batch.
2. Where an anchor hash has several different stretches, one of each is cut out of its text. Blocks of
   such stretches are suffix-sorted: suffixes smaller than their successors are sorted directly, the
   others are placed by scans over the buckets of first bytes, and adjacent common prefixes tell
   which windows are equal.
3. Spans are merged per document and cut out.

Texts are UTF-8 bytes; matches never cross documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.registry import query
from millrace.llm.similar import BASE, BASE_INVERSE, BYTE_CODE, mixed
from millrace.llm.texts import as_bytes, table_of, tidy
from millrace.session import scratch
from millrace.tables import table

LENGTH = 200
GRAM = 64
CHUNK = 1 << 19  # windows of a text that are looked at together
BLOCK = 1 << 19  # bytes that are suffix-sorted together
MANY = 10_000  # different stretches of one anchor hash, above which windows are dealt out one by one
_MASK = (1 << 64) - 1


class Anchors:
    """Stretches of windows with one anchor, for byte strings."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM) -> None:
        self.length, self.gram, self.reach = length, gram, length - gram + 1
        size = CHUNK + length
        self.up, self.down = (np.full(size, b & _MASK, np.uint64) for b in (BASE, BASE_INVERSE))
        for powers in (self.up, self.down):
            powers[0] = 1
            np.multiply.accumulate(powers, out=powers)

    def slid(self, x: np.ndarray, best) -> np.ndarray:
        """The smallest or largest of each ``reach`` neighbours."""
        w = 1
        while 2 * w <= self.reach:
            x = best(x[:-w], x[w:])
            w *= 2
        rest = self.reach - w
        return best(x[:-rest], x[rest:]) if rest else x

    def stretches(self, raw: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor hash, first window, number of windows, place of the anchor behind the first window)."""
        for begin in range(0, max(0, len(raw) - self.length + 1), CHUNK):
            data = np.frombuffer(raw, np.uint8)[begin : begin + CHUNK + self.length - 1]
            total = np.concatenate(([np.uint64(0)], np.cumsum(BYTE_CODE[data] * self.up[: len(data)], dtype=np.uint64)))
            n = len(data) - self.gram + 1
            h = mixed((total[self.gram :] - total[:n]) * self.down[:n])
            least = self.slid(h, np.minimum)
            edge = np.zeros(self.reach - 1, np.uint64)
            chosen = np.flatnonzero(h == self.slid(np.concatenate((edge, least, edge)), np.maximum))
            low = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
            high = np.concatenate((low[1:], [len(least)]))
            while len(low):
                at = np.searchsorted(chosen, low)
                value = least[low]
                while (off := np.flatnonzero(h[chosen[at]] != value)).size:
                    at[off] += 1
                anchor = chosen[at]
                end = np.minimum(high, anchor + 1)  # windows behind the anchor have the next of the same hash
                yield value.view(np.int64), low + begin, end - low, anchor - low
                low, high = end[end < high], high[end < high]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of a byte string in the order of their suffixes, compared on ``depth`` bytes or more.

    A suffix is sorted directly if it is smaller than its successor; in a bucket of one first byte these
    come last. The others are placed in front of them, in the order in which a scan over the buckets
    meets their successors.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    change = np.flatnonzero(text[1:] != text[:-1])
    rises = np.append(text[change + 1] > text[change], False)
    direct = rises[np.searchsorted(change, np.arange(n))]
    raw = text.tobytes()
    order = np.array(sorted(np.flatnonzero(direct).tolist(), key=lambda i: raw[i : i + depth]), np.int64)
    by_byte = np.split(order, np.searchsorted(text[order], np.arange(1, 256)))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))
    placed = []
    for byte in range(256):
        wave = np.concatenate(waiting[byte]) if waiting[byte] else np.empty(0, np.int64)
        bucket = []
        while len(wave):
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[(text[before] == byte) & ~direct[before]]
        bucket.append(by_byte[byte])
        bucket = np.concatenate(bucket)
        placed.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~direct[before] & (text[before] > byte)]
        before = before[np.argsort(text[before], kind="stable")]
        for part in np.split(before, np.flatnonzero(np.diff(text[before])) + 1):
            if len(part):
                waiting[text[part[0]]].append(part)
    return np.concatenate(placed)


def equal_windows(segments: list[bytes], groups: np.ndarray, counts: np.ndarray, shifts: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each segment, which of its first ``counts`` windows equal one of another segment of its group.

    Windows are compared where they are as far from the anchor, which lies ``shifts`` behind the start.
    """
    sizes = np.array([len(s) for s in segments])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    text = np.frombuffer(b"".join(segments), np.uint8)
    padded = np.concatenate((text, np.zeros(length + 8, np.uint8)))
    order = suffix_order(text, length)
    owner = np.searchsorted(starts, order, "right") - 1
    within = order - starts[owner]
    window = within < counts[owner]
    order, owner, within = order[window], owner[window], within[window]
    # Adjacent common prefixes, eight bytes at a time, as far as a window goes.
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    left = np.arange(len(order) - 1)
    for at in range(0, length, 8):
        at = min(at, length - 8)
        left = left[(eights[order[left] + at] == eights[order[left + 1] + at]).all(1)]
    same = np.zeros(len(order), bool)
    same[left + 1] = True
    number = np.cumsum(~same)
    key = np.stack((number, groups[owner], shifts[owner] - within), 1)
    found = np.lexsort(key.T[::-1])
    ranked = key[found]
    twin = (ranked[1:] == ranked[:-1]).all(1)
    again = np.zeros(len(order), bool)
    again[found[1:][twin]] = True
    again[found[:-1][twin]] = True
    result = [np.zeros(c, bool) for c in counts]
    for i, w in zip(owner[again], within[again]):
        result[i][w] = True
    return result


def spans_of(flags: np.ndarray, first: int, length: int) -> list[tuple[int, int]]:
    """Byte spans covered by the marked windows, the first of which starts at ``first``."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return [(first + int(a), first + int(b) - 1 + length) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


STRETCH = "anchor long, content long, key long, first long, windows long, shift long, copies long"


def _stretches(stream: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Distinct stretches of each batch, with the place of one copy; ``copies`` 0: a span that repeats within the batch."""
    anchors = Anchors(length, gram)
    for batch in stream:
        keys = batch.column(0).to_numpy()
        parts: list[tuple[np.ndarray, ...]] = []
        for i, raw in enumerate(batch.column(1).to_pylist()):
            view = memoryview(raw)
            for anchor, first, windows, shift in anchors.stretches(raw):
                ends = (first + windows + length - 1).tolist()
                content = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), ends)), np.uint64, len(first))
                content = mixed(content ^ (shift.astype(np.uint64) << np.uint64(32)))
                parts.append((anchor, content.view(np.int64), np.full(len(first), i), first, windows, shift))
        if not parts:
            continue
        anchor, content, row, first, windows, shift = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((content, anchor))
        new = np.concatenate(([True], (np.diff(anchor[order]) != 0) | (np.diff(content[order]) != 0)))
        copies = np.diff(np.append(np.flatnonzero(new), len(order)))
        one = order[new]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (anchor[one], content[one], keys[row[one]], first[one], windows[one], shift[one], copies)],
            ["anchor", "content", "key", "first", "windows", "shift", "copies"],
        )
        many = np.sort(order[np.repeat(copies > 1, copies)])
        rows = []
        for i in np.unique(row[many]):
            own = many[row[many] == i] if len(many) < 1000 else many[np.searchsorted(row[many], i) : np.searchsorted(row[many], i, "right")]
            rows += [(int(keys[i]), a, b - length + 1 - a) for a, b in merged([(int(f), int(f + w) - 1 + length) for f, w in zip(first[own], windows[own])])]
        if rows:
            key, at, count = (np.array(x) for x in zip(*rows))
            zero = np.zeros(len(rows), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (zero, zero, key, at, count, zero, zero)], ["anchor", "content", "key", "first", "windows", "shift", "copies"])


VERDICT = "anchor long, key long, first long, windows long, shift long, verdict int"
WHOLE, ASKS, PARTNER = 0, 1, 2


def _verdicts(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by anchor and content: those that repeat as a whole, and those to compare.

    Of anchors with several contents, each content comes once: it asks for its windows' fate, or, if it
    repeats as a whole, it is only a partner. 4 is added to the verdicts of anchors with very many.
    """
    held: list[np.ndarray] | None = None

    def judged(columns: list[np.ndarray]) -> pa.RecordBatch:
        anchor, content, key, first, windows, shift, copies = columns
        new_anchor = np.concatenate(([True], np.diff(anchor) != 0))
        new = new_anchor | np.concatenate(([True], np.diff(content) != 0))
        at = np.flatnonzero(new)
        total = np.add.reduceat(copies, at)
        group = np.cumsum(new_anchor)[at] - 1
        contents = np.bincount(group)[group]
        rows, verdict = [], []
        whole = np.flatnonzero((np.repeat(total, np.diff(np.append(at, len(new)))) > 1) & (copies == 1))
        rows.append(whole)
        verdict.append(np.full(len(whole), WHOLE))
        several = contents > 1
        rows.append(at[several])
        verdict.append(np.where(total[several] > 1, PARTNER, ASKS) + 4 * (contents[several] > MANY))
        pick = np.concatenate(rows)
        arrays = [pa.array(x[pick]) for x in (anchor, key, first, windows, shift)] + [pa.array(np.concatenate(verdict).astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, ["anchor", "key", "first", "windows", "shift", "verdict"])

    for batch in stream:
        now = [batch.column(i).to_numpy() for i in range(7)]
        now = now if held is None else [np.concatenate(x) for x in zip(held, now)]
        if not len(now[0]):
            continue
        last = int(np.searchsorted(now[0], now[0][-1]))  # rows of the last anchor may go on in the next batch
        if last:
            yield judged([x[:last] for x in now])
        held = [x[last:] for x in now]
    if held is not None and len(held[0]):
        yield judged(held)


SEGMENT = "anchor long, part int, key long, first long, windows long, shift long, asks boolean, bytes binary"


def _segments(stream: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted stretches, in whole or window by window."""
    names = ["anchor", "part", "key", "first", "windows", "shift", "asks", "bytes"]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in stream:
        raw = batch.column(batch.schema.get_field_index("__bytes"))
        wanted = batch.column(batch.schema.get_field_index("wanted"))
        keys = batch.column(batch.schema.get_field_index("__key")).to_pylist()
        rows: list[tuple] = []
        for i, key in enumerate(keys):
            value = raw[i].as_py()
            for w in wanted[i].as_py():
                a, n, asks = w["first"], w["windows"], w["verdict"] & 3 == ASKS
                if w["verdict"] < 4:
                    rows.append((w["anchor"], 0, key, a, n, w["shift"], asks, value[a : a + n + length - 1]))
                else:
                    for k in range(n):
                        window = value[a + k : a + k + length]
                        rows.append((w["anchor"], xxhash.xxh32_intdigest(window) >> 12, key, a + k, 1, w["shift"] - k, asks, window))
            if len(rows) > 20_000:
                yield made(rows)
                rows = []
        if rows:
            yield made(rows)


def _compared(stream: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(key, a, b): spans of asking stretches that repeat in part. Rows come sorted by anchor and part."""
    held: list[tuple] = []
    size = groups = 0
    last = None

    def found() -> pa.RecordBatch | None:
        marks = equal_windows([r[7] for r in held], np.array([r[8] for r in held]), np.array([r[4] for r in held]), np.array([r[5] for r in held]), length)
        spans = [(r[2], a, b) for r, m in zip(held, marks) if r[6] and m.any() for a, b in spans_of(m, r[3], length)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*spans)], ["key", "a", "b"]) if spans else None

    for batch in stream:
        for row in zip(*(batch.column(i).to_pylist() for i in range(8))):
            if row[:2] != last:
                if size > BLOCK:
                    if (out := found()) is not None:
                        yield out
                    held, size = [], 0
                last, groups = row[:2], groups + 1
            held.append((*row, groups))
            size += len(row[7])
    if held and (out := found()) is not None:
        yield out


def remove_repeats(docs: DataFrame, keep: list[str], length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Columns ``keep`` of every document (doc_id, text) with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes left.

    A null or empty text, and one shorter than ``length`` bytes, loses nothing. A repeated row is a
    document of its own, so both lose all windows. Cuts follow bytes and may divide a character.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession

    def written(df: DataFrame, label: str) -> DataFrame:
        path = scratch(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    raw = as_bytes(F.col("text"))
    rows = docs.select(*keep, raw.alias("__bytes"), F.xxhash64("doc_id", raw).alias("__key"))
    found = written(rows.select("__key", "__bytes").mapInArrow(tidy(lambda s: _stretches(s, length, gram)), STRETCH), "stretches")
    dealt = found.filter("copies > 0").repartition("anchor").sortWithinPartitions("anchor", "content", "key", "first")
    verdicts = written(dealt.mapInArrow(tidy(_verdicts), VERDICT), "stretch-verdicts")

    last = (F.col("first") + F.col("windows") + (length - 1)).alias("b")
    whole = found.filter("copies = 0").select("key", F.col("first").alias("a"), last)
    whole = whole.unionAll(verdicts.filter(f"verdict = {WHOLE}").select("key", F.col("first").alias("a"), last))

    # One plan reads the texts twice by key: Spark shuffles them once and reuses the exchange.
    asked = verdicts.filter(f"verdict <> {WHOLE}").groupBy("key").agg(F.collect_list(F.struct("anchor", "first", "windows", "shift", "verdict")).alias("wanted"))
    segments = rows.join(asked, rows["__key"] == asked["key"]).drop("key").mapInArrow(tidy(lambda s: _segments(s, length)), SEGMENT)
    segments = segments.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "key", "first")
    parts = segments.mapInArrow(tidy(lambda s: _compared(s, length)), "key long, a long, b long")
    spans = whole.unionAll(parts).groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            raw = batch.column(batch.schema.get_field_index("__bytes")).to_pylist()
            kept, count, removed = [], [], []
            for value, own in zip(raw, batch.column(batch.schema.get_field_index("spans")).to_pylist()):
                gone = merged([(s["a"], s["b"]) for s in own]) if own else []
                edges = [0, *(x for s in gone for x in s), len(value)]
                left = b"".join(value[a:b] for a, b in zip(edges[::2], edges[1::2]))
                kept.append(left)
                count.append(len(gone))
                removed.append(len(value) - len(left))
            yield table_of(
                batch, keep, n_bytes=pa.array([len(v) for v in raw], pa.int64()), n_removed=pa.array(removed, pa.int64()),
                n_spans=pa.array(count, pa.int64()), kept=pa.array(kept, pa.binary()),
            )

    schema = docs.select(*keep).schema
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")
    return rows.join(spans, rows["__key"] == spans["key"], "left").drop("key").mapInArrow(tidy(cut), schema.add("kept", "binary"))


@query("op8_repeats")
def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, folder, "documents"), ["doc_id"])
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
