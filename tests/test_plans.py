"""The plans Spark makes: pushdown, pruning, no cross join, no Python in built-in operators."""

import re

import pytest

from millrace.plans import all_queries
from millrace.tables import table

QUERIES = all_queries()
USES_PYTHON = {"udf_python", "udf_pandas", "udf_registered"}
# Queries that only build a plan: no files are written on the way.
LAZY = sorted(n for n in QUERIES if n.split("_")[0] in {"p", "f", "x", "j", "a", "w", "o", "s", "d", "m", "n", "arr", "js", "udf", "v"} or n in {
    "c_top_revenue", "c_abandoned", "c_clickpath", "c_item_pivot", "c_clean_users", "c_user_summary"
})


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


@pytest.mark.parametrize("name", LAZY)
def test_plan_shape(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in USES_PYTHON:
        assert "EvalPython" not in text and "InPandas" not in text


def test_filter_and_columns_reach_the_scan(spark, small):
    text = plan(QUERIES["f_string"](spark, small))
    assert "GreaterThan(o_totalprice,400000.0)" in text and "EqualTo(o_orderstatus,F)" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>", text)


def test_adjacent_and_repeated_filters_become_one(spark, small):
    orders = table(spark, small, "orders")
    text = plan(orders.filter("o_totalprice > 10").filter("o_totalprice > 10").filter("o_orderkey > 5"), "simple")
    assert text.count("+- Filter") + text.count("*(1) Filter") + text.startswith("Filter") <= 1


def test_a_cache_before_a_filter_blocks_pushdown(spark, small):
    orders = table(spark, small, "orders").cache()
    try:
        assert "PushedFilters: [IsNotNull(o_totalprice)" not in plan(orders.filter("o_totalprice > 10"))
    finally:
        orders.unpersist()
    assert "GreaterThan(o_totalprice,10.0)" in plan(table(spark, small, "orders").filter("o_totalprice > 10"))


def test_library_does_not_cache():
    from pathlib import Path

    import millrace

    code = "\n".join(p.read_text() for p in Path(millrace.__file__).parent.rglob("*.py"))
    assert ".cache(" not in code and ".persist(" not in code and "localCheckpoint" not in code


def test_partition_filter_prunes(spark, folder, small):
    from millrace.operators.snapshots import SnapshotTable

    t = SnapshotTable(spark, folder)
    t.create(table(spark, small, "orders").selectExpr("o_orderkey", "year(o_orderdate) AS y"), partition_by=["y"])
    assert re.search(r"PartitionFilters: \[[^\]]*y#\d+ = 1996", plan(t.read().filter("y = 1996")))


def test_top_k_needs_no_full_sort(spark, small):
    text = plan(QUERIES["o_topk"](spark, small))
    assert "TakeOrderedAndProject" in text


def test_listed_pivot_shuffles_once(spark, small):
    from pyspark.sql import functions as F

    from millrace.operators.pivot import pivot_listed

    df = pivot_listed(table(spark, small, "events"), ["user_id"], "event_type", ["click", "view"], F.count, F.lit(1))
    assert plan(df, "simple").count("Exchange") == 1


def test_actions(spark, small):
    df = table(spark, small, "part").orderBy("p_partkey")
    assert len(df.take(5)) == 5 and df.first() == df.head() == df.limit(1).collect()[0] and df.count() == table(spark, small, "part").count()
