"""Near-duplicate documents: all links of a Jaccard join on word shingles, by a token-group matrix.

A document's set are the hashes of its distinct shingles. Documents with equal sets are one entry.
Tokens are put in one order, rarest first; two sets with Jaccard at least t share ``SHARED`` tokens among
the first n - ceil(t n) + SHARED of either (the head of a set of n). Different sets with a link share at
least six tokens at t = 0.85 and four at t = 0.8, so there are that many.

1. In a few rounds, each entry is checked against one entry of another group, of those that come first
   at its head tokens the one it shares most with. The links found join entries to groups of similar
   documents; an entry without a link is a group of one.
2. The token-group matrix has a row for each head token and entry where several groups still meet.
   At a token of few entries, pairs of fitting size are counted; those that meet ``SHARED`` times stay.
   At a token of many, groups are bounded first: a group's token union is kept as a bitmap of token buckets. The number of a query's buckets outside
   the union bounds its overlap with every member from above; only groups whose bound reaches the
   threshold are opened, and their members go through the same test one by one. Tokens of nearly the
   same entries are looked at together, in one cell.
3. The pairs left are checked exactly, on the sets themselves. At a token of many entries that happens at
   once, and groups with a link are one from then on.

Links within a group need no search, as its members are connected already; no link between groups is
lost: a pair shares a token of many entries, or ``SHARED`` tokens of few. Components are the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.graphs import components
from millrace.llm.registry import query
from millrace.llm.texts import as_bytes, pieces, slices, tidy
from millrace.session import Steps
from millrace.tables import table

WORDS = 4
PERCENT = 85
COMMON = 1_000_000  # tokens that the order knows as frequent, at most; the order never changes the result
OFTEN = 3  # documents of an Arrow batch that make a token worth counting
BLOCK = 2048  # entries of a cell that meet in one block
SHARED = 3
FEW = 32  # entries of a token whose pairs are counted rather than bounded
STARS = 2  # rounds of the first step, at most
BROADCAST_IDS = 500_000  # ids sent to every task to pick their texts, at most; more are joined by shuffle
PAIRS_AT_ONCE = 250_000  # pairs whose texts are brought together at a time
ROWS_AT_ONCE = 20_000_000  # rows of head tokens that are shuffled at a time
PARTS = 8  # where there are more, they are dealt to so many parts at most
RUN = 50_000  # rows of a frequent head token that are looked at together in the first step
BATCH_BYTES = 1 << 20

_random = np.random.default_rng(20240607)
BYTE_CODE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x5851F42D4C957F2D
BASE_INVERSE = pow(BASE, -1, 1 << 64)
LANES = tuple(int(x) | 1 for x in _random.integers(0, 1 << 63, 8, dtype=np.uint64))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits, one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes:
    """Hashes of the words of byte strings, by differences of one running sum over their bytes."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, np.uint64)
        self.is_white = np.zeros(256, bool)
        self.is_white[[0x20, 9, 10, 11, 12, 13]] = True
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[0x41:0x5B] += 32

    def powers(self, n: int) -> None:
        size = max(n, BATCH_BYTES + 1)
        if len(self.up) < n:
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                factors = np.full(size, base & (1 << 64) - 1, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))

    def __call__(self, raw: bytes) -> np.ndarray:
        if not raw:
            return np.empty(0, np.uint64)
        data = np.frombuffer(raw, np.uint8)
        white = self.is_white[data]
        edge = np.diff(np.concatenate(([True], white, [True])).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.powers(len(data))
        total = np.concatenate(([np.uint64(0)], np.cumsum(BYTE_CODE[self.lower[data]] * self.up[: len(data)], dtype=np.uint64)))
        return mixed((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


class Shingles:
    """Sets of shingle hashes of texts, as sorted arrays."""

    def __init__(self, words: int = WORDS) -> None:
        self.words, self.hashes = words, WordHashes()

    def sets(self, values: list[bytes]) -> Iterator[np.ndarray]:
        held, last = [], 0
        for i, piece in pieces(values, BATCH_BYTES, hard=False):
            if i != last:
                yield self.one(held)
                held, last = [], i
            held.append(self.hashes(piece))
        if values:
            yield self.one(held)

    def one(self, parts: list[np.ndarray]) -> np.ndarray:
        h = parts[0] if len(parts) == 1 else np.concatenate(parts)
        k = min(self.words, len(h))
        if not k:
            return h
        n = len(h) - k + 1
        code = np.full(n, k, np.uint64)
        for j in range(k):
            code += h[j : j + n] * np.uint64(LANES[j % 8]) + np.uint64(j)
        return np.unique(mixed(code))


def head_length(n: int, percent: int) -> int:
    return min(n, n - (percent * n + 99) // 100 + SHARED)


def bitmap(tokens: np.ndarray) -> bytes:
    """Which token buckets are taken; two to four times as many buckets as tokens, a power of two."""
    width = 1 << max(6, int(2 * len(tokens) - 1).bit_length())
    taken = np.zeros(width, bool)
    taken[(tokens & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(taken, bitorder="little").tobytes()


def folded(bits: bytes, width: int) -> np.ndarray:
    """A bitmap at a smaller width: a bucket is taken if one of those it joins is."""
    words = np.frombuffer(bits, np.uint64)
    return np.bitwise_or.reduce(words.reshape(-1, width // 64), axis=0)


def opened(
    ids: np.ndarray, groups: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], maps: list[bytes], percent: int
) -> Iterator[tuple[int, int]]:
    """Links (smaller id, larger id) that connect all groups that any link connects.

    Bounds on groups and members decide which sets are compared. Two groups with a link are one from
    then on, so their other members need no comparing. Where the entries come from two blocks, only
    pairs between the blocks are wanted.
    """
    _, at = np.unique(groups, return_inverse=True)
    members = np.split(np.argsort(at, kind="stable"), np.cumsum(np.bincount(at))[:-1])
    sizes = np.array([len(x) for x in sets])
    least, most = np.array([sizes[m].min() for m in members]), np.array([sizes[m].max() for m in members])
    widths = np.array([len(x) * 8 for x in maps])
    narrow = np.array([widths[m].min() for m in members])
    two = len(np.unique(blocks)) > 1
    unions: dict[int, np.ndarray] = {}
    grids: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    joined = np.arange(len(members))  # the same number for groups that are one by now

    def grid(width: int) -> tuple[np.ndarray, np.ndarray]:
        """The bitmaps that are so wide, folded to the width, and where each entry's is."""
        if width not in grids:
            wide = np.flatnonzero(widths >= width)
            place = np.zeros(len(ids), np.int64)
            place[wide] = np.arange(len(wide))
            grids[width] = np.stack([folded(maps[k], width) for k in wide]), place
        return grids[width]

    def union(width: int) -> np.ndarray:
        if width not in unions:
            bits, place = grid(width)
            unions[width] = np.stack([
                np.bitwise_or.reduce(bits[place[m]], axis=0) if w >= width else np.zeros(width // 64, np.uint64)
                for m, w in zip(members, narrow)
            ])
        return unions[width]

    def fitting(i: int, wanted: list[int]) -> np.ndarray:
        """Members of the wanted groups that sizes and bitmaps allow a link with, as ``may_link`` does."""
        k, n = np.concatenate([members[g] for g in wanted]), sizes[i]
        k = k[(ids[k] > ids[i]) & (100 * np.minimum(sizes[k], n) >= percent * np.maximum(sizes[k], n))]
        k = k[blocks[k] != blocks[i]] if two else k
        fit, shared = np.zeros(len(k), bool), np.minimum(widths[k], widths[i])
        for width in np.unique(shared):
            here = np.flatnonzero(shared == width)
            bits, place = grid(int(width))
            x, y = bits[place[i]], bits[place[k[here]]]
            overlap = np.minimum(n - np.bitwise_count(x & ~y).sum(1, dtype=np.int64), sizes[k[here]] - np.bitwise_count(y & ~x).sum(1, dtype=np.int64))
            fit[here] = 100 * overlap >= percent * (n + sizes[k[here]] - overlap)
        return k[fit]

    for i in range(len(ids)):
        n = len(sets[i])
        near = np.flatnonzero((percent * least <= 100 * n) & (100 * most >= percent * n) & (joined != joined[at[i]]))
        spare = n - (percent * n + 99) // 100  # tokens of the query that a partner may lack
        shared = np.minimum(narrow[near], widths[i])
        wanted: list[int] = []
        for width in np.unique(shared):
            here = near[shared == width]
            bits, place = grid(int(width))
            outside = np.bitwise_count(bits[place[i]] & ~union(int(width))[here]).sum(1)
            wanted += here[outside <= spare].tolist()
        for k in fitting(i, wanted) if wanted else ():
            if joined[at[k]] != joined[at[i]] and linked(sets[i], sets[k], percent):
                joined[joined == joined[at[k]]] = joined[at[i]]
                yield int(ids[i]), int(ids[k])


def may_link(n: int, m: int, a: bytes, b: bytes, percent: int) -> bool:
    """Whether sizes and bitmaps allow the threshold."""
    if 100 * min(n, m) < percent * max(n, m):
        return False
    width = min(len(a), len(b)) * 8
    x, y = folded(a, width), folded(b, width)
    overlap = min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))
    return 100 * overlap >= percent * (n + m - overlap)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exactly: 100 * intersection >= percent * union, for sorted sets without repeats."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a):
        return False
    shared = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _common(docs: DataFrame, words: int) -> DataFrame:
    def counted(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in stream:
            for part in slices(batch, 5000):
                token, n = np.unique(np.concatenate(list(shingles.sets(part.column(0).to_pylist()))), return_counts=True)
                often = n >= OFTEN
                yield pa.RecordBatch.from_arrays([pa.array(token[often].view(np.int64)), pa.array(n[often])], ["token", "n"])

    found = docs.select(as_bytes(F.col("text"))).mapInArrow(tidy(counted), "token long, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(COMMON)


def _sets(docs: DataFrame, common: np.ndarray, words: int, percent: int) -> DataFrame:
    """(doc_id, n, digest, bits, head) of each document. ``common``: frequent tokens, the most frequent first."""
    places = np.argsort(common, kind="stable")
    shared = docs.sparkSession.sparkContext.broadcast((common[places], len(common) - 1 - places))

    def described(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, (frequent, place) = Shingles(words), shared.value
        for batch in chain.from_iterable(map(slices, stream)):
            n, digest, bits, head = [], [], [], []
            for tokens in shingles.sets(batch.column(1).to_pylist()):
                n.append(len(tokens))
                digest.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                bits.append(bitmap(tokens) if len(tokens) else b"")
                order = tokens >> np.uint64(1)
                if len(frequent) and len(tokens):
                    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
                    known = frequent[at] == tokens
                    order[known] = np.uint64(1 << 63) + place[at[known]].astype(np.uint64)
                k = head_length(len(tokens), percent) if len(tokens) else 0
                head.append(tokens[np.argpartition(order, k - 1)[:k]].view(np.int64) if k else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bits, pa.binary()), pa.array(head, pa.list_(pa.int64()))],
                ["doc_id", "n", "digest", "bits", "head"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), as_bytes(F.col("text")).alias("bytes"))
    return rows.mapInArrow(tidy(described), "doc_id long, n long, digest binary, bits binary, head array<long>")


def _meetings(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, entry, n): rows of tokens that several entries share.

    Rows come sorted by token, cell and entry; a token's first row is held until a second one comes.
    """
    last, lead = None, None
    for batch in stream:
        token, cell, entry, n = (batch.column(i).to_numpy() for i in range(4))
        if not len(token):
            continue
        starts = np.concatenate(([0], np.flatnonzero((token[1:] != token[:-1]) | (cell[1:] != cell[:-1])) + 1))
        lengths = np.diff(np.concatenate((starts, [len(token)])))
        more = last == (token[0], cell[0])
        several = lengths > 1
        several[0] |= more
        several |= cell[starts] >= 0  # of a token in several cells, every row counts
        keep = np.repeat(several, lengths)
        rows = [x[keep] for x in (token, entry, n)]
        if more and lead is not None:
            rows = [np.concatenate(([x], y)) for x, y in zip((token[0], *lead), rows)]
        last, lead = (token[-1], cell[-1]), None if several[-1] else (entry[-1], n[-1])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["token", "entry", "n"])


def _exact(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts' sets link."""

    def checked(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, last, right = Shingles(words), None, None
        for batch in stream:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keep = []
            for i in range(batch.num_rows):
                if b[i] != last:  # rows of one b come together
                    last, right = b[i], next(shingles.sets([batch.column(3)[i].as_py()]))
                keep.append(linked(next(shingles.sets([batch.column(2)[i].as_py()])), right, percent))
            yield pa.RecordBatch.from_arrays([pa.array(a[np.array(keep, bool)]), pa.array(b[np.array(keep, bool)])], ["a", "b"])

    left = texts.select(F.col("doc_id").alias("a"), F.col("bytes").alias("a_bytes"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("bytes").alias("b_bytes"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "a_bytes", "b_bytes").mapInArrow(tidy(checked), "a long, b long")


def sent(ids: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast if it is small."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _ids(pairs: DataFrame, steps: Steps) -> DataFrame:
    ids = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select(F.col("b").alias("doc_id"))).distinct()
    return sent(steps.written(ids, "pair-ids"))


def _parts(rows: DataFrame, key: str, most: int) -> list[DataFrame]:
    """A written table dealt by a key, to be worked on part by part, so that not all of it is in a shuffle at a time."""
    parts = max(1, min(PARTS, -(-rows.count() // most)))
    return [rows.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == part) for part in range(parts)]


def _checked(pairs: DataFrame, docs: DataFrame, words: int, percent: int, steps: Steps) -> DataFrame:
    """The pairs (a, b) whose texts' sets link, written. The texts of one part of the pairs are on disk at a time."""
    spark, links = docs.sparkSession, []
    texts = docs.select(F.col("doc_id").cast("long"), as_bytes(F.col("text")).alias("bytes"))
    with Steps(spark) as own:
        for here in _parts(own.written(pairs, "pairs"), "b", PAIRS_AT_ONCE):
            with Steps(spark) as now:
                found = now.written(texts.join(_ids(here, now), "doc_id", "left_semi"), "pair-texts")
                links.append(steps.written(_exact(here, found, words, percent), "links"))
    return reduce(DataFrame.unionAll, links)


def _grouped(meetings: DataFrame, edges: DataFrame | None, steps: Steps) -> DataFrame:
    """(token, entry, n, group, __count) of tokens where several groups meet. Without edges each entry is a group."""
    if edges is None:
        return meetings.withColumns({"group": F.col("entry"), "__count": F.lit(0)})
    groups = components(edges, keep=steps).select(F.col("node").alias("entry"), "component")
    rows = meetings.join(groups, "entry", "left").select("token", "entry", "n", F.coalesce("component", "entry").alias("group"))
    with Steps(meetings.sparkSession) as own:
        met = []
        for here in _parts(own.written(rows, "token-groups"), "token", ROWS_AT_ONCE):
            several = here.groupBy("token").agg(F.min("group").alias("__a"), F.max("group").alias("__b"), F.count(F.lit(1)).alias("__count"))
            several = several.filter("__a < __b").select("token", "__count")
            met.append(steps.written(here.join(several, "token"), "token-groups"))
    return reduce(DataFrame.unionAll, met)


def _bounded(pairs: DataFrame, sets: DataFrame, percent: int, steps: Steps) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps allow the threshold."""

    def passed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            n, m, x, y = (batch.column(i).to_pylist() for i in range(2, 6))
            keep = pa.array([may_link(*row, percent) for row in zip(n, m, x, y)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    pairs = steps.written(pairs, "pairs")
    maps = steps.written(sets.filter("n > 0").select("doc_id", "n", "bits").join(_ids(pairs, steps), "doc_id", "left_semi"), "pair-maps")
    left = maps.select(F.col("doc_id").alias("a"), F.col("n").alias("a_n"), F.col("bits").alias("a_bits"))
    right = maps.select(F.col("doc_id").alias("b"), F.col("n").alias("b_n"), F.col("bits").alias("b_bits"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.select("a", "b", "a_n", "b_n", "a_bits", "b_bits").mapInArrow(tidy(passed), "a long, b long").distinct()


def _fit(n, m, percent: int):
    return percent * F.greatest(n, m) <= 100 * F.least(n, m)


def _stars(rows: DataFrame, sets: DataFrame, percent: int, number: int, steps: Steps) -> DataFrame:
    """Each entry of ``_grouped`` rows with one entry of another group that it may link with.

    Of the first group at a token, another entry leads in every round.
    """
    first = rows.groupBy("token").agg(F.min(F.struct("group", F.xxhash64("entry", F.lit(number)).alias("order"), "entry", "n")).alias("first"))
    met = rows.join(first, "token").filter((F.col("group") != F.col("first.group")) & _fit(F.col("n"), F.col("first.n"), percent))
    counts = met.groupBy("entry", F.col("first.entry").alias("lead")).count().filter(F.col("count") >= SHARED)
    best = counts.groupBy("entry").agg(F.max(F.struct("count", (-F.col("lead")).alias("down"))).alias("best"))
    return _bounded(best.select(F.col("entry").alias("a"), (-F.col("best.down")).alias("b")), sets, percent, steps)


def _counted(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different groups that meet at ``SHARED`` tokens of few entries."""

    def pairs(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def met(columns: list[np.ndarray]) -> pa.RecordBatch:
            token, entry, n, group = columns
            found = []
            for k in range(1, FEW):  # each row with the k-th behind it
                if k >= len(token):
                    break
                ok = (token[k:] == token[:-k]) & (group[k:] != group[:-k]) & (entry[k:] != entry[:-k])
                ok &= percent * np.maximum(n[k:], n[:-k]) <= 100 * np.minimum(n[k:], n[:-k])
                found.append((entry[:-k][ok], entry[k:][ok]))
            a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for batch in stream:
            now = [batch.column(i).to_numpy() for i in range(4)]
            now = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            if not len(now[0]):
                continue
            last = int(np.searchsorted(now[0], now[0][-1]))
            yield met([x[:last] for x in now])
            held = [x[last:] for x in now]
        if held is not None and len(held[0]):
            yield met(held)

    few = rows.filter(F.col("__count") <= FEW).select("token", "entry", "n", "group").repartition("token").sortWithinPartitions("token", "entry")
    return few.mapInArrow(tidy(pairs), "a long, b long").groupBy("a", "b").count().filter(F.col("count") >= SHARED).select("a", "b")


def _cells(rows: DataFrame, steps: Steps) -> DataFrame:
    """(cell, entry, group) of (token, entry, group, __count) rows, each once.

    Tokens with the same first entry, by a hash, are one cell, so that a set is sent to it once. Where
    such tokens have few entries in common, each is a cell of its own.
    """
    tokens = rows.groupBy("token").agg(F.min(F.xxhash64("entry")).alias("__first"), F.max("__count").alias("__count"))
    tokens = steps.written(tokens, "matrix-tokens")
    entries = rows.select("token", "entry").join(tokens, "token").select("__first", "entry").distinct()
    tight = tokens.groupBy("__first").agg(F.max("__count").alias("__most")).join(entries.groupBy("__first").agg(F.count(F.lit(1)).alias("__all")), "__first")
    tight = tight.filter("__all <= 2 * __most").select("__first", F.col("__first").alias("__cell"))
    cell = tokens.join(tight, "__first", "left").select("token", F.coalesce("__cell", "token").alias("cell"))
    return rows.select("token", "entry", "group").join(steps.written(cell, "matrix-tokens"), "token").select("cell", "entry", "group").distinct()


def _opened(rows: DataFrame, docs: DataFrame, words: int, percent: int, steps: Steps) -> DataFrame:
    """Links (a, b) that connect the groups that meet at a token of many entries, by bounds and exact sets."""
    rows = steps.written(rows.filter(F.col("__count") > FEW).select("token", "entry", "group", "__count"), "token-group-matrix")
    wanted = sent(steps.written(rows.select(F.col("entry").alias("doc_id")).distinct(), "matrix-ids"))

    def hashed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in stream:
            for part in slices(batch):
                tokens = pa.array([x.tobytes() for x in shingles.sets(part.column(1).to_pylist())], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), tokens], ["entry", "tokens"])

    texts = docs.select(F.col("doc_id").cast("long"), as_bytes(F.col("text")).alias("bytes")).join(wanted, "doc_id", "left_semi")
    tokens = steps.written(texts.mapInArrow(tidy(hashed), "entry long, tokens binary"), "matrix-sets")
    rows = steps.written(_cells(rows, steps), "matrix-cells")
    blocks = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("__blocks"))
    rows = rows.join(blocks, "cell").join(tokens, "entry")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("entry"), F.col("__blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    rows = rows.withColumn("__other", other).withColumns({"low": F.least("block", "__other"), "high": F.greatest("block", "__other")})

    def links(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def found() -> pa.RecordBatch:
            entry, group, block, raw = zip(*held)
            own = [np.frombuffer(x, np.uint64) for x in raw]
            got = list(opened(np.array(entry), np.array(group), np.array(block), own, [bitmap(x) for x in own], percent))
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in got], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in stream:
            for *key, entry, group, block, raw in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if key != now:
                    if len(held) > 1:
                        yield found()
                    now, held = key, []
                held.append((entry, group, block, raw))
        if len(held) > 1:
            yield found()

    dealt = rows.select("cell", "low", "high", "entry", "group", "block", "tokens").repartition("cell", "low", "high")
    return dealt.sortWithinPartitions("cell", "low", "high", "entry").mapInArrow(tidy(links), "a long, b long").distinct()


def similar(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document, from columns doc_id and text.

    Null, empty and blank texts have no shingles and are components of their own. A text with fewer
    words than a shingle has one, its whole sequence. Rows that repeat an id count as one document.
    Documents without an id link with nothing and have no component. An empty table gives an empty result.
    Different sets of a similarity under 67 percent may share fewer than ``SHARED`` tokens; it is refused.
    """
    if not 67 <= percent <= 100:
        raise ValueError("a similarity has 67 to 100 percent")
    spark = docs.sparkSession
    with Steps(spark) as steps:
        return Steps(spark).written(_similar(docs, words, percent, steps), "similar")


def _similar(docs: DataFrame, words: int, percent: int, steps: Steps) -> DataFrame:
    spark = docs.sparkSession
    common = steps.written(_common(docs, words), "common-tokens")
    frequent = common.orderBy(F.desc("n"), "token").toArrow().column("token").to_numpy().view(np.uint64)
    sets = steps.written(_sets(docs, frequent, words, percent), "shingle-sets")
    able = sets.filter("n > 0 AND doc_id IS NOT NULL")
    classes = steps.written(able.groupBy("digest").agg(F.min("doc_id").alias("entry")), "set-classes")

    # A token in more rows than RUN is looked at in several cells; one that is not in the list is rare.
    cells = common.filter(F.col("n") > RUN).select("token", F.ceil(F.col("n") / RUN).alias("__cells"))
    heads = able.select("doc_id", "n", "head").join(sent(classes.select(F.col("entry").alias("doc_id"))), "doc_id", "left_semi")
    heads = heads.select(F.explode("head").alias("token"), F.col("doc_id").alias("entry"), "n").join(F.broadcast(cells), "token", "left")
    heads = heads.select("token", F.coalesce(F.pmod(F.xxhash64("entry"), F.col("__cells")), F.lit(-1)).cast("int").alias("cell"), "entry", "n")
    heads = heads.repartition("token", "cell").sortWithinPartitions("token", "cell", "entry")
    meetings = steps.written(heads.mapInArrow(tidy(_meetings), "token long, entry long, n long"), "shared-tokens")

    edges = None
    for number in range(STARS):
        with Steps(spark) as own:
            stars = _stars(_grouped(meetings, edges, own), sets, percent, number, own)
            more = _checked(stars, docs, words, percent, steps)
        edges = more if edges is None else edges.unionAll(more)
        if more.isEmpty():
            break
    edges = spark.createDataFrame([], "a long, b long") if edges is None else edges
    with Steps(spark) as own:
        rows = _grouped(meetings, edges, own)
        with Steps(spark) as matrix:
            many = steps.written(_opened(rows, docs, words, percent, matrix), "links")
        few = _checked(_bounded(_counted(rows, percent), sets, percent, own), docs, words, percent, steps)
    edges = edges.unionAll(many).unionAll(few)

    known = components(edges, keep=steps)
    classes = classes.join(known.select(F.col("node").alias("entry"), "component"), "entry", "left")
    classes = steps.written(classes.select("digest", F.coalesce("component", "entry").alias("component")), "class-components")
    rows = sets.select("doc_id", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    return rows.join(classes, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


@query("op7_similar")
def op7_similar(spark: SparkSession, folder: str) -> DataFrame:
    return similar(table(spark, folder, "documents"))
