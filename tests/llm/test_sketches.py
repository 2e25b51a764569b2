import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import sketches
from millrace.llm.registry import ORACLES, QUERIES

WHITE = "\t\n\x0b\x0c\r"


def plain_sketch(text, share=0.25):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else " " if c in WHITE else c for c in text or "")
    words = [w for w in lowered.split(" ") if w]
    shingles = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    hashes = {hashlib.md5(s.encode()).hexdigest()[:16] for s in shingles}
    return sorted(h for h in hashes if int(h, 16) < share * 2**64)


def plain(rows):
    """(doc_id, text) rows to the query's, ties by the md5 of the text."""
    key = lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5((r[1] or "").encode()).hexdigest())
    rows, out = sorted(rows, key=key), []
    for i, (doc_id, text) in enumerate(rows):
        text, other = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + other[:half]
        a, b, c = (plain_sketch(t) for t in (text, changed, other))
        near = lambda x, y: len(set(x) & set(y)) / min(len(x), len(y)) if x and y else 0.0
        alike = lambda x, y: len(set(x) & set(y)) / len(set(x) | set(y)) if x or y else 0.0
        sha = hashlib.sha256(changed.encode()).hexdigest()
        out.append((doc_id, len(text), sha, "".join(a), "".join(b), near(a, b), near(a, c), alike(a, b), alike(a, c)))
    return sorted(out, key=str)


def rounded(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@pytest.mark.parametrize("case", ["given", "edge", "one id", "one row", "none"])
def test_query_against_plain_sketches(spark, small, docs, folder, case):
    random.seed(2)
    several = [(random.choice([None, 7, 7, 7, -(2**63), 2**63 - 1]), " ".join(random.choice("ABCDEFGH") for _ in range(random.randint(0, 30)))) for _ in range(200)]
    frames = {
        "given": spark.read.parquet(f"{small}/documents.parquet"), "edge": docs, "one row": docs.filter("doc_id = 1"),
        "one id": spark.createDataFrame(several, "doc_id long, text string").dropDuplicates(), "none": docs.limit(0),
    }
    frame = frames[case].withColumn("fingerprint", F.lit(1)).withColumn("key", F.lit(2))
    frame.write.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op11_sketches"](spark, folder).collect()
    assert rounded(tuple(r) for r in got) == rounded(plain([(r.doc_id, r.text) for r in frame.collect()]))


def test_sketches_merge_and_measure(spark):
    words = [f"w{i}" for i in range(4000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:400])), (3, " ".join(words[200:600])), (4, " ".join(words).upper())]
    found = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", sketches.sketch(F.col("text")).alias("s"))
    by_id = {r.doc_id: r.s for r in found.collect()}
    assert by_id[1] == by_id[4] == plain_sketch(rows[0][1])
    pairs = found.alias("a").join(found.alias("b"), F.expr("a.doc_id < b.doc_id")).select(
        F.col("a.doc_id").alias("x"), F.col("b.doc_id").alias("y"), sketches.shared(F.col("a.s"), F.col("b.s")).alias("both"), F.size("a.s").alias("a"), F.size("b.s").alias("b"),
    )
    seen = {(r.x, r.y): (r.inside, r.like, r.same) for r in pairs.select(
        "x", "y", sketches.containment(F.col("both"), F.col("b")).alias("inside"), sketches.likeness(F.col("both"), F.col("a"), F.col("b")).alias("like"),
        sketches.resemblance(F.col("both"), F.col("a"), F.col("b")).alias("same"),
    ).collect()}
    assert seen[1, 2][:2] == (1.0, 1.0) and abs(seen[1, 2][2] - 0.1) < 0.05
    assert abs(seen[2, 3][0] - 0.5) < 0.15
    both = found.filter("doc_id IN (2, 3)").agg(sketches.merged(F.collect_list("s")).alias("s")).first().s
    assert both == sorted({*by_id[2], *by_id[3]})


def test_no_python_in_the_plan(spark, small):
    plan = QUERIES["op11_sketches"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "op11_sketches" in ORACLES
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
