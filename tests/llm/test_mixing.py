import math

from millrace.compare import compare, oracle_connection
from millrace.llm import mixing
from millrace.llm.registry import ORACLES, QUERIES


def test_equals_sql(spark, small):
    assert compare(QUERIES["op6_mixing"](spark, small), oracle_connection(small), ORACLES["op6_mixing"]) is None


def test_no_python_in_the_plan(spark, small):
    plan = QUERIES["op6_mixing"](spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def targets(spark, sizes):
    rows = mixing.source_targets(spark.createDataFrame(sizes, "source string, size long")).collect()
    return {r.source: r.target for r in rows}


def test_targets_by_weight_null_last(spark):
    got = targets(spark, [("b", 100), (None, 100), ("a", 100)])
    assert [round(got[k], 6) for k in ("a", "b", None)] == [187.5, 75.0, 37.5]


def test_excess_is_shared_again(spark):
    got = targets(spark, [("a", 10), ("b", 1000), ("c", 1000), ("d", 0)])
    assert got["a"] == 30 and got["d"] == 0 and math.isclose(sum(got.values()), 2010) and math.isclose(got["b"], 2 * got["c"])


def test_edge_rows(spark, docs):
    sized = docs.withColumn("size", mixing.word_count(docs.text)).withColumnRenamed("n_chars", "copy")
    got = mixing.mix(sized).collect()
    assert len(got) == docs.count() and {"text", "copy", "lang"} <= set(got[0].asDict())
    assert all(0 <= r.copies <= 3 for r in got) and all(r.size == len((r.text or "").encode().split()) for r in got)


def test_taken_is_near_target_in_a_hot_source(spark):
    rows = spark.range(30_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 7)) AS source", "1 + id * 7919 % 400 AS size")
    got = mixing.mix(rows).groupBy("source").agg({"target": "max", "source_size": "max"}).collect()
    taken = {r.source: r.t for r in mixing.mix(rows).selectExpr("source", "copies * size AS t").groupBy("source").sum("t").withColumnRenamed("sum(t)", "t").collect()}
    assert all(abs(taken[r.source] - r["max(target)"]) <= 800 for r in got)


def test_empty_table(no_docs):
    assert mixing.mix(no_docs.withColumn("size", mixing.word_count(no_docs.text))).count() == 0
