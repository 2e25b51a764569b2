"""Repair of conversations: the cheapest edits that make the roles alternate again.

A conversation shall read ``(s?(ua)+)?`` in the initials of its roles. Its rows are dealt by
conversation and sorted by turn, the last one first, and stream through ``mapInArrow``; what is carried
from row to row, across Arrow batches, is the cost of the cheapest way to the end from each of four
states (nothing yet, behind s, behind u, behind a). A row leaves one byte: the first edit to make in
each state. As the edits of a state all bear different letters, the smallest letter among the
cheapest gives the least string of letters. When the first row has come, the edits are read off
from the front.

A conversation that outgrows ``held`` bytes does not stay in memory: its rows go out with their
bytes into a written table, and a second pass over that table alone, sorted from the front, reads
the edits off. A conversation passes through one task, as its hash has to; the memory is bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.registry import query
from millrace.llm.texts import slices, tidy
from millrace.session import scratch
from millrace.tables import table

WHITE = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, OPEN_END = 2, 3, 2, 1  # costs; keeping is free, an open end is added to what is not deleted
EMPTY, SYSTEM, USER, ASSISTANT = range(4)  # states: what has been put out last
NEXT = (USER, USER, ASSISTANT, USER)  # the state that an inserted or renamed row leads to
ROLE = {USER: "user", ASSISTANT: "assistant"}
LETTERS = "DIKR"
D, I, K, R = range(4)
LEGAL = {"su", "ua", "au"}
HELD = 32 << 20  # bytes of one conversation's rows in memory
FINAL = (0, 2 * INSERT, INSERT, 0)  # cost of ending in each state
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def step(costs: tuple, initial: str, delete: bool, open_end: bool) -> tuple[tuple, int]:
    """(costs in front of a row, its edits as two bits a state) from the costs behind the row."""
    best, edit = [], []
    for state in range(4):
        cost, letter = costs[state] + DELETE, D
        if not delete:
            to = NEXT[state]
            kept = costs[SYSTEM] if initial == "s" and state == EMPTY else costs[to] if initial == ROLE[to][0] else None
            if kept is not None and kept + open_end * OPEN_END < cost:
                cost, letter = kept + open_end * OPEN_END, K
            named = costs[to] + REROLE + open_end * OPEN_END
            if named < cost:
                cost, letter = named, R
        best.append(cost)
        edit.append(letter)
    # An insertion leads to another state in front of the same row; two in a circle never pay.
    out, packed = [], 0
    for state in range(4):
        to = NEXT[state]
        other = min(best[to], best[NEXT[to]] + INSERT) + INSERT
        cost, letter = best[state], edit[state]
        if other < cost or other == cost and letter > I:
            cost, letter = other, I
        out.append(cost)
        packed |= letter << 2 * state
    return tuple(out), packed


class Reading:
    """Edits read off from the front: the state, their letters, and the hash of the repaired rows so far."""

    def __init__(self) -> None:
        self.state, self.letters, self.hash, self.any = EMPTY, bytearray(), hashlib.sha256(), False

    def put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.any else "") + role + ":" + text).encode("utf-8", "replace"))
        self.any = True

    def insert(self) -> None:
        self.letters += b"I"
        self.state = NEXT[self.state]
        self.put(ROLE[self.state], "")

    def row(self, role: str, text: str, packed: int) -> None:
        while (letter := packed >> 2 * self.state & 3) == I:
            self.insert()
        self.letters += LETTERS[letter].encode()
        if letter == K:
            self.state = SYSTEM if self.state == EMPTY and role[:1] == "s" else NEXT[self.state]
            self.put(role, text)
        elif letter == R:
            self.state = NEXT[self.state]
            self.put(ROLE[self.state], text)

    def end(self) -> tuple[str, str]:
        while FINAL[self.state]:
            self.insert()
        return self.letters.decode(), self.hash.hexdigest()


class Conversation:
    """Rows of one conversation, the last one first."""

    def __init__(self, key) -> None:
        self.key, self.costs, self.rows, self.bytes, self.seen, self.spilled = key, FINAL, [], 0, 0, False
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.behind = None

    def add(self, turn, role: str, text: str, repeated: bool) -> None:
        end = text.rstrip(WHITE)
        blank = not end
        open_end = not blank and not repeated and end[-1] not in ".!?"
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += open_end
        self.illegal += self.behind is not None and role[:1] + self.behind not in LEGAL
        self.behind = role[:1]
        if turn is not None and turn != self.first:
            self.turns, self.first = self.turns + 1, turn
            self.last = turn if self.last is None else self.last
        self.costs, packed = step(self.costs, role[:1], blank or repeated, open_end)
        self.rows.append((self.seen, role, text, packed))
        self.seen += 1
        self.bytes += 200 + 2 * len(text)

    def counts(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.costs[EMPTY]

    def edits(self) -> tuple[str, str]:
        reading = Reading()
        for _, role, text, packed in reversed(self.rows):
            reading.row(role, text, packed)
        return reading.end()


def _sorted_rows(rows: DataFrame, present: Column) -> DataFrame:
    """Rows dealt by conversation, the last first; ``repeated`` where role and text came before in the conversation."""
    rows = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.coalesce(present, F.lit(False)).alias("present"),
    )
    alike = Window.partitionBy("conv_id", "present", "role", F.md5(F.col("text").cast("binary"))).orderBy(F.col("turn").asc_nulls_first())
    # One shuffle: what is dealt by conversation is dealt well enough for the window too.
    marked = rows.repartition("conv_id").withColumn("repeated", F.row_number().over(alike) > 1)
    return marked.sortWithinPartitions("conv_id", F.col("turn").desc_nulls_last(), F.desc("role"), F.desc("text"), F.desc("repeated"))


def repaired(rows: DataFrame, present: Column | None = None, held: int = HELD) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text): its faults, cost, edits and hash.

    Rows for which ``present`` does not hold count only to name their conversation. A null role or text is
    one space; null turns come first; rows of one turn go by role and text. A null conv_id is a
    conversation. Alike rows of one turn are duplicates but for one. A conversation without rows has
    zeros, no edits and the hash of the empty text; so has one whose rows all go, but for its counts.
    """
    spark = rows.sparkSession
    ordered = _sorted_rows(rows, F.lit(True) if present is None else present)
    key = rows.schema["conv_id"]
    out = rows.select("conv_id").schema
    for name in COUNTS:
        out = out.add(name, "long")
    out = out.add("audit", "string").add("repaired_sha256", "string").add("place", "long").add("role", "string").add("text", "string").add("edits", "integer")
    kinds = [pa.int64()] * len(COUNTS) + [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32()]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []

        def spill(c: Conversation) -> None:
            done.extend((c.key, *[None] * (len(COUNTS) + 2), *row) for row in c.rows)
            c.rows, c.bytes, c.spilled = [], 0, True

        def close(c: Conversation) -> None:
            if c.spilled:
                spill(c)
            done.append((c.key, *c.counts(), *((None, None) if c.spilled else c.edits()), None, None, None, None))

        def sent() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [[]] * len(out)
            arrays = [pa.array(columns[0], key_kind)] + [pa.array(c, k) for c, k in zip(columns[1:], kinds)]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, out.names)

        for whole in stream:
            key_kind = whole.schema.field(0).type
            for batch in slices(whole):
                for conv, turn, role, text, is_present, repeated in zip(*[c.to_pylist() for c in batch.columns]):
                    if current is None or conv != current.key:
                        if current is not None:
                            close(current)
                        current = Conversation(conv)
                    if is_present:
                        current.add(turn, role, text, repeated)
                        if current.bytes > held:
                            spill(current)
                yield sent()
        if current is not None:
            close(current)
            yield sent()

    path = scratch(spark, "turns")
    ordered.select("conv_id", "turn", "role", "text", "present", "repeated").mapInArrow(tidy(batches), out).write.parquet(path)
    passed = spark.read.schema(out).parquet(path)
    whole = passed.filter("place IS NULL").select("conv_id", *COUNTS, "audit", "repaired_sha256")
    if passed.filter("place IS NOT NULL").isEmpty():
        return whole
    giants = passed.filter("place IS NOT NULL").select("conv_id", "place", "role", "text", "edits")
    read = _read_off(giants, key.dataType).withColumnsRenamed({"conv_id": "__id", "audit": "__audit", "repaired_sha256": "__hash"})
    joined = whole.join(read, F.col("conv_id").eqNullSafe(F.col("__id")), "left")
    return joined.select("conv_id", *COUNTS, F.coalesce("audit", "__audit").alias("audit"), F.coalesce("repaired_sha256", "__hash").alias("repaired_sha256"))


def _read_off(rows: DataFrame, kind) -> DataFrame:
    """Edits and hash of spilled conversations, streamed from the front."""
    schema = rows.select("conv_id").schema.add("audit", "string").add("repaired_sha256", "string")

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, reading = None, None
        for whole in stream:
            kind = whole.schema.field(0).type
            ended = []
            for batch in slices(whole):
                for conv, _, role, text, packed in zip(*[c.to_pylist() for c in batch.columns]):
                    if reading is None or conv != key:
                        if reading is not None:
                            ended.append((key, *reading.end()))
                        key, reading = conv, Reading()
                    reading.row(role, text, packed)
            ids, letters, hashes = zip(*ended) if ended else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(letters, pa.string()), pa.array(hashes, pa.string())], schema.names)
        if reading is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((key, *reading.end()), (kind, pa.string(), pa.string()))], schema.names)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("place")).mapInArrow(tidy(batches), schema)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults that the crc32 of conversation and turn choose; dropped rows stay, ``present`` false.

    0 drops a row, 1 empties its text, 2 takes the ends of sentences out, 3 repeats it, 4 makes it the user's. Nulls
    are one space.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    marked = rows.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") <= 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    changed = marked.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("fault") != 0).alias("present"), F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return changed.drop("copy")


@query("op12_turns")
def op12_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest repair and its hash of every damaged conversation."""
    return repaired(damaged(table(spark, folder, "conversations")), F.col("present"))
