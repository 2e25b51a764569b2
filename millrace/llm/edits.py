"""Token counts of documents that are edited, without encoding them anew.

A document's pre-tokens, the pieces that a byte-level vocabulary encodes one by one, are kept in a
segment tree: a leaf stands for ``FAN`` pre-tokens and holds their characters and tokens, an inner
node the sums of its two children. An edit (start, length, insert) walks down to the leaves it
touches. Encoding starts a leaf boundary before the edit, where the pattern that makes pre-tokens
cannot have looked at the changed characters, and goes on until it meets an old leaf boundary
behind the edit; from there on all pre-tokens are the old ones. The leaves in between are replaced
and the sums above them brought up to date.

Trees are columns (arrays of characters and tokens per leaf), so they can be written beside the
documents and used by the next run; the inner nodes are rebuilt from the leaves when first needed.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.packing import chunks
from millrace.llm.registry import query
from millrace.llm.texts import as_bytes, table_of, tidy
from millrace.tables import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
FAN = 32  # pre-tokens of a leaf
SPECIAL = "<|endoftext|>"  # one token, as in packing; texts are split there before the pattern applies
LOOK = 3 + len(SPECIAL)  # characters behind a pre-token that its end may depend on, and one more
LONG = 2000  # bytes of a pre-token that goes to the encoder without its own splitting
REMEMBERED = 200_000  # counts of pre-tokens that a worker remembers
Edits = list[tuple[int, int, str]]


class Known(dict):
    """Token counts by pre-token, encoded when first asked for."""

    def __init__(self, encode: Callable[[str], list[int]]) -> None:
        self.encode = encode

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece))
        if len(piece) < LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n


class Counter:
    """Pre-tokens and their token counts."""

    def __init__(self, ranks: str) -> None:
        import tiktoken

        with open(ranks, "rb") as file:
            found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=found, special_tokens={})
        self.pattern, self.known = regex.compile(public_tokenizers.PATTERN), Known(self.ids)

    def ids(self, piece: str) -> list[int]:
        """Tokens of one pre-token, past the encoder's own splitting, which recurses over long white space."""
        if piece == SPECIAL:
            return [-1]
        raw = piece.encode("utf-8", "replace")
        return self.encoding._core_bpe.encode_single_piece(raw)

    def pieces(self, text: str, at: int = 0) -> Iterator[str]:
        """Pre-tokens from ``at`` on; they depend on what is behind ``at`` alone."""
        while at < len(text):
            stop = text.find(SPECIAL, at)
            # The pattern covers every character, and takes the special token's place for the end of the text.
            yield from (m.group() for m in self.pattern.finditer(text, at, len(text) if stop < 0 else stop))
            if stop < 0:
                break
            yield SPECIAL
            at = stop + len(SPECIAL)

    def leaves(self, text: str) -> list[tuple[int, int]]:
        """(characters, tokens) of each leaf of a text.

        Tokens are counted by pre-token: a leaf's text alone may be cut otherwise, as white space at
        its end belongs to what follows.
        """
        out, known = [], self.known
        for part in chunks(text):
            pieces = list(self.pieces(part)) if SPECIAL in part else self.pattern.findall(part)
            sizes, tokens = list(map(len, pieces)), list(map(known.__getitem__, pieces))
            out += [(sum(sizes[i : i + FAN]), sum(tokens[i : i + FAN])) for i in range(0, len(pieces), FAN)]
        return out


class Tree:
    """A segment tree over leaves: node 1 is the root, node k's children are 2k and 2k + 1."""

    def __init__(self, leaves: list[tuple[int, int]]) -> None:
        self.build(leaves)

    def build(self, leaves: list[tuple[int, int]]) -> None:
        self.used, self.size = len(leaves), 1 << max(0, len(leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (c, t) in enumerate(leaves, self.size):
            self.chars[i], self.tokens[i] = c, t
        for node in range(self.size - 1, 0, -1):
            self.add_up(node)

    def add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def leaves(self) -> list[tuple[int, int]]:
        """All leaves with characters."""
        span = slice(self.size, self.size + self.used)
        return [x for x in zip(self.chars[span], self.tokens[span]) if x[0]]

    def find(self, at: int) -> tuple[int, int]:
        """(leaf that holds character ``at``, its first character); behind the end, the last leaf."""
        at, node, before = min(at, self.chars[1] - 1), 1, 0
        while node < self.size:
            node *= 2
            if at - before >= self.chars[node]:
                before += self.chars[node]
                node += 1
        return node - self.size, before

    def replace(self, low: int, high: int, new: list[tuple[int, int]]) -> None:
        """Put ``new`` in the place of leaves ``low`` to before ``high`` and update the sums above them.

        Fewer leaves are filled up with empty ones, a few more share a place. Where many are new, the
        tree is laid out anew; nothing is encoded for that.
        """
        room = high - low
        if len(new) > 4 * room:
            span = slice(self.size, self.size + self.used)
            old = list(zip(self.chars[span], self.tokens[span]))
            self.build([x for x in old[:low] + new + old[high:] if x[0]])
            return
        share = -(-len(new) // room) if new else 1
        for i in range(room):
            part = new[i * share : (i + 1) * share]
            self.chars[self.size + low + i] = sum(c for c, _ in part)
            self.tokens[self.size + low + i] = sum(t for _, t in part)
        a, b = (self.size + low) // 2, (self.size + high - 1) // 2
        while a >= 1:
            for node in range(a, b + 1):
                self.add_up(node)
            a, b = a // 2, b // 2


class Document:
    """A text, its tree, and how many characters have been encoded since the tree was given."""

    def __init__(self, text: str, leaves: list[tuple[int, int]], counter: Counter) -> None:
        self.text, self.tree, self.counter, self.encoded = text, Tree(leaves), counter, 0

    def edit(self, start: int, length: int, insert: str) -> None:
        """Replace ``length`` characters from ``start`` on; both are cut to the text."""
        start = min(max(0, start), len(self.text))
        length = min(max(0, length), len(self.text) - start)
        shift = len(insert) - length
        self.text = self.text[:start] + insert + self.text[start + length :]
        tree = self.tree
        if not tree.chars[1]:
            tree.build(self.counter.leaves(self.text))
            self.encoded += len(self.text)
            return
        low, at = tree.find(max(0, start - LOOK))
        high, end = tree.find(start + length)
        end += tree.chars[tree.size + high]
        new, chars, tokens, pieces, begin = [], 0, 0, 0, at
        for piece in self.counter.pieces(self.text, at):
            at, chars, tokens, pieces = at + len(piece), chars + len(piece), tokens + self.counter.known[piece], pieces + 1
            while end + shift < at and high + 1 < tree.used:
                high += 1
                end += tree.chars[tree.size + high]
            met = at == end + shift and at >= start + len(insert)
            if met or pieces == FAN:
                new.append((chars, tokens))
                chars = tokens = pieces = 0
            if met:
                break
        else:
            high = tree.used - 1
        if pieces:
            new.append((chars, tokens))
        self.encoded += at - begin
        tree.replace(low, high + 1, new)


LEAVES = T.ArrayType(T.IntegerType())


def with_trees(docs: DataFrame, keep: list[str], ranks: str = RANKS) -> DataFrame:
    """Columns ``keep`` and ``text`` of every document, its tree's leaves and ``n_tokens``.

    A null text counts as empty: no leaves, 0 tokens. Repeated rows get a tree each.
    """

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks)
        for batch in stream:
            texts = [b.decode("utf-8", "replace") for b in batch.column(batch.num_columns - 1).to_pylist()]
            leaves = [counter.leaves(t) for t in texts]
            yield table_of(
                batch, keep, text=pa.array(texts, pa.string()), leaf_chars=pa.array([[c for c, _ in x] for x in leaves], pa.list_(pa.int32())),
                leaf_tokens=pa.array([[t for _, t in x] for x in leaves], pa.list_(pa.int32())), n_tokens=pa.array([sum(t for _, t in x) for x in leaves], pa.int64()),
            )

    rows = docs.select(*keep, as_bytes(F.col("text")).alias("__bytes"))
    schema = docs.select(*keep).schema.add("text", "string").add("leaf_chars", LEAVES).add("leaf_tokens", LEAVES).add("n_tokens", "long")
    return rows.mapInArrow(tidy(batches), schema)


def edited(docs: DataFrame, keep: list[str], edits: str | Callable[[str], Edits], ranks: str = RANKS) -> DataFrame:
    """Apply edits to documents with trees; columns ``keep``, then the new text, tree and count, and the work done.

    ``docs`` has the columns of ``with_trees``. ``edits`` names a column, an array of structs (start,
    length, insert), or is a function that finds them in a text. They are applied in turn, each to the
    text the one before has left. Null edits, starts, lengths and inserts count as none, 0 and empty; what
    lies outside the text is cut off. ``n_encoded`` counts the characters that were encoded again.
    """
    column = edits if isinstance(edits, str) else None
    find = None if column else edits

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks)
        for batch in stream:
            get = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()
            texts, done, counts = get("__text"), [], []
            given = [find(t) for t in texts] if find else [[(e["start"] or 0, e["length"] or 0, e["insert"] or "") for e in x or [] if e] for x in get("__edits")]
            for text, chars, tokens, own in zip(texts, get("__leaf_chars"), get("__leaf_tokens"), given):
                document = Document(text, list(zip(chars, tokens)), counter)
                for edit in own:
                    document.edit(*edit)
                done.append((document.text, document.tree.leaves(), document.tree.tokens[1], document.encoded))
                counts.append(len(own))
            yield table_of(
                batch, keep, text=pa.array([d[0] for d in done], pa.string()), leaf_chars=pa.array([[c for c, _ in d[1]] for d in done], pa.list_(pa.int32())),
                leaf_tokens=pa.array([[t for _, t in d[1]] for d in done], pa.list_(pa.int32())), n_tokens=pa.array([d[2] for d in done], pa.int64()),
                n_edits=pa.array(counts, pa.int64()), n_encoded=pa.array([d[3] for d in done], pa.int64()),
            )

    names = ["text", "leaf_chars", "leaf_tokens", *([column] if column else [])]
    rows = docs.select(*keep, *[F.col(n).alias("__edits" if n == column else f"__{n}") for n in names])
    schema = docs.select(*keep).schema.add("text", "string").add("leaf_chars", LEAVES).add("leaf_tokens", LEAVES)
    for name in ("n_tokens", "n_edits", "n_encoded"):
        schema = schema.add(name, "long")
    return rows.mapInArrow(tidy(batches), schema)


PRIVATE = re.compile(r"(?P<mail>[\w.+-]{1,64}@[\w-]+(?:\.[\w-]+)+)|(?P<number>\+?\d[\d ()./-]{6,}\d)")


def redactions(text: str) -> Edits:
    """Edits that replace mail addresses and long numbers by their kind, the last one first."""
    found = [(m.start(), m.end() - m.start(), f"[{m.lastgroup}]") for m in PRIVATE.finditer(text)]
    return found[::-1]


@query("op4_edits")
def op4_edits(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all documents before and after redaction."""
    before = with_trees(table(spark, folder, "documents"), ["doc_id"]).withColumnRenamed("n_tokens", "n_tokens_before")
    after = edited(before, ["doc_id", "n_tokens_before"], redactions)
    return after.select(
        "doc_id", "n_tokens_before", "n_edits", "n_tokens", F.length("text").cast("long").alias("n_chars"), "n_encoded", F.size("leaf_tokens").alias("n_leaves")
    )
