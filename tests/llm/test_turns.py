import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import turns
from millrace.llm.registry import QUERIES

WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        if not text.strip(WHITE):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if text.rstrip(WHITE)[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, letters, repaired rows): all edits in the order of their cost, then letters."""
    kinds, heap, done = faults(rows), [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, i, roles, kept = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, letters, kept
        if (i, roles[-1:]) in done:
            continue
        done.add((i, roles[-1:]))
        options = [(2, "I", i, x, (n, "")) for x, n in (("u", "user"), ("a", "assistant"))]
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 3, letters + "D", i + 1, roles, kept))
            if kinds[i] not in ("blank", "duplicate"):
                more = kinds[i] == "truncated"
                options += [(2 + more, "R", i + 1, x, (n, text)) for x, n in (("u", "user"), ("a", "assistant"))]
                options += [(more, "K", i + 1, role[:1], (role, text))] if role[:1] else []
        for price, letter, to, x, row in options:
            if x in "sua" and re.fullmatch("s?(ua)*u?", roles + x):
                heapq.heappush(heap, (cost + price, letters + letter, to, roles + x, kept + (row,)))


def digest(rows):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows).encode()).hexdigest()


def expected(conv, given):
    """given: (turn, role, text, alive), sorted by turn."""
    rows = [(r, t) for _, r, t, alive in given if alive]
    numbers = [x[0] for x in given if x[3] and x[0] is not None]
    kinds = faults(rows)
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, letters, kept = cheapest(rows)
    return (conv, gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, letters, digest(kept))


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out.setdefault(conv, []).extend([(turn, "user" if fault == 4 else role, text, fault != 0)] * (2 if fault == 3 else 1))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())
    return {conv: sorted(given, key=key) for conv, given in out.items()}


def test_the_cheapest_edits_of_short_conversations():
    random.seed(3)
    for _ in range(1500):
        rows = [(random.choice(["system", "user", "assistant", "user", "assistant", "tool", " ", ""]), random.choice(["", " \t", "x.", "y", "z!", "w ? ", "q"])) for _ in range(random.randint(0, 6))]
        c, kinds = turns.Conversation(1), faults(rows)
        for k in reversed(range(len(rows))):
            c.add(k, *rows[k], rows[k] in rows[:k])
        cost, letters, kept = cheapest(rows)
        assert (c.costs[0], *c.edits()) == (cost, letters, digest(kept))
        assert (c.blank, c.duplicate, c.truncated) == tuple(kinds.count(x) for x in ("blank", "duplicate", "truncated"))


@pytest.fixture(scope="module")
def chats():
    random.seed(8)
    rows = []
    for conv in range(250):
        for turn in range(random.randint(1, 9)):
            rows.append((conv, turn, ["user", "assistant"][turn % 2], random.choice(["hi.", "so?", "open", "Well done!", "ok. "]) + str(random.randint(0, 3)) * random.randint(0, 1)))
    rows += [(300, None, "user", "a."), (300, None, None, "b."), (300, 4, "assistant", None), (300, 4, "assistant", "two\nlines."), (300, 9, "", "c.")]
    rows += [(None, 1, "user", "no id."), (None, 1, "user", "no id."), (None, 2, "system", "late."), (301, 5, "system", "alone."), (302, None, None, None)]
    rows += [(303, 7, "user", "x" * 200_000), (303, 8, "assistant", "é." * 100_000)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_query_against_exhaustive_search(spark, folder, chats):
    spark.createDataFrame(chats, SCHEMA).withColumn("cost", F.lit("clash")).repartition(5).write.parquet(f"{folder}/conversations.parquet")
    got = sorted((tuple(r) for r in QUERIES["op12_turns"](spark, folder).collect()), key=str)
    want = damaged(chats)
    assert any(not any(x[3] for x in given) for given in want.values())  # all rows dropped
    assert got == sorted((expected(c, given) for c, given in want.items()), key=str)


def test_given_conversations(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op12_turns"](spark, small).collect())
    assert got == sorted(expected(c, given) for c, given in damaged(rows).items())


def test_spilled_conversations_are_read_alike(spark, chats):
    long = [(500, i, random.choice(["user", "assistant", "tool"]), random.choice(["same.", "open", f"row {i}.", ""])) for i in range(5000)]
    rows = turns.damaged(spark.createDataFrame(chats + long, SCHEMA))
    whole = {r.conv_id: tuple(r) for r in turns.repaired(rows, F.col("present")).collect()}
    spilled = {r.conv_id: tuple(r) for r in turns.repaired(rows, F.col("present"), held=1500).collect()}
    assert whole == spilled and len(whole) == len({c for c, *_ in chats}) + 1
    assert len(whole[500][7]) >= 4000


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert turns.repaired(turns.damaged(none), F.col("present")).count() == 0
    gone = spark.createDataFrame([(1, 1, "user", "a.")], SCHEMA)
    assert [tuple(r) for r in turns.repaired(gone, F.lit(False)).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
