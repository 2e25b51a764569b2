from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import numbers, text, times
from millrace.operators import cleaning, hotkeys, nesting, protect, quality
from millrace.operators.pivot import pivot_listed
from millrace.sources import jdbc, timefolders


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_with_hot_keys(spark, how, null_safe):
    key = F.when(F.col("id") < 900, 0).when(F.col("id") >= 1400, F.col("id") % 50).cast("long")  # 500 rows have none
    rows = spark.range(2000).select(key.alias("k"), F.col("id").alias("v"))
    other = spark.createDataFrame([(0, "a"), (0, "b"), (7, "c"), (None, "n"), (1000, "x")], "k long, w string")
    names = {0: ["a", "b"], 7: ["c"]}
    if null_safe:
        names[None] = ["n"]
    want = []
    for i in range(2000):
        k = 0 if i < 900 else i % 50 if i >= 1400 else None
        want += [(k, i, w) for w in names.get(k, [None] if how == "left" else [])]
    got = hotkeys.join_hot_keys(rows, other, ["k"], how, null_safe, limit=100)
    assert got.columns == ["k", "v", "w"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_hot_key_spreads_over_parts(spark):
    rows = spark.range(1000).select(F.lit(1).alias("k"), F.lit("copy").alias("v"))
    parts = hotkeys.numbered_part(rows, ["k"], hotkeys.large_keys(rows, ["k"], 100), "p").groupBy("p").count().collect()
    assert len(parts) == 10 and max(r["count"] for r in parts) < 150
    assert hotkeys.large_keys(rows, ["k"], 10_000) is None


def test_sampled_search_finds_exactly_the_large_keys(spark):
    rows = spark.range(60000).select(F.when(F.col("id") < 20000, None).when(F.col("id") < 22000, 1).when(F.col("id") < 22900, 2).otherwise(F.col("id")).alias("k"))
    found = hotkeys.large_keys(rows, ["k"], 1000)
    assert sorted(map(tuple, found.collect()), key=str) == [(1, 2), (None, 20)]
    assert hotkeys.large_keys(rows.filter("k > 2"), ["k"], 1000) is None


def test_unnest_keeps_empty_only_on_request(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "k int, a array<int>")
    assert nesting.unnest(df, "a").count() == 2
    assert nesting.unnest(df, "a", keep_empty=True).count() == 4


def test_pivot_equals_builtin(spark):
    df = spark.createDataFrame([(1, "A", 1.0), (1, "B", 2.0), (1, "A", 3.0), (2, "B", None)], "k int, c string, v double")
    want = df.groupBy("k").pivot("c", ["A", "B", "C"]).sum("v").toDF("k", "a", "b", "c")
    assert sorted(pivot_listed(df, ["k"], "c", ["A", "B", "C"], F.sum, "v").collect()) == sorted(want.collect())


def test_latest_and_collapse(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 9, "z"), (2, 1, None)], "k int, t int, v string")
    assert sorted(cleaning.latest_per_key(df.filter("k IS NOT NULL"), ["k"], ["t"]).collect()) == [(1, 2, "b"), (2, 1, None)]
    assert sorted(cleaning.collapse(df, ["k"], ["v"]).collect(), key=str) == [(1, "b"), (2, None)]
    assert cleaning.null_counts(df, ["k", "v"]).first() == (1, 1)


def test_text_and_numbers(spark):
    df = spark.createDataFrame([("ab.c@x-y.com", 1.239), ("a@b", -1.239), (None, None)], "s string, v double")
    got = df.select(text.is_email("s"), text.email_domain("s"), text.mask_tail("s"), numbers.cut_decimals("v")).collect()
    assert [tuple(r) for r in got] == [(True, "x-y.com", "**********om", 1.23), (False, "b", "*@b", -1.23), (None, None, None, None)]


def test_rounded_sums_keep_small_large_and_nan(spark):
    total = lambda value, **kw: spark.range(1000).agg(numbers.rounded_sum(value, **kw)).first()[0]
    assert total(F.lit(0.1)) == 100.0 and total(F.lit(1e-5)) == 0.01 and total(F.lit(2e15)) == 2e18
    assert total(F.when(F.col("id") == 3, float("nan")).otherwise(1.0)) != total(F.lit(1.0))
    assert str(total(F.lit(float("nan")))) == "nan" and total(F.lit(float("inf"))) == float("inf")
    assert spark.range(0).agg(numbers.rounded_sum("id"), numbers.rounded_avg("id")).first() == (None, None)


def test_micros_are_exact(spark):
    micros = 9_007_199_254_740_993  # one more than a double can hold
    df = spark.createDataFrame([(micros,)], "m long").select(times.to_micros(times.from_micros("m")))
    assert df.first()[0] == micros


def test_expectations_treat_null_as_broken(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "v int")
    rules = [quality.Expectation("small", "v < 3", quality.DROP)]
    assert [r["v"] for r in quality.keep_expected(df, rules).collect()] == [1]
    assert quality.expectation_counts(df, rules, "d").first()[1:] == ("small", 1, 2)
    with pytest.raises(Exception, match="small"):
        quality.keep_expected(df, [quality.Expectation("small", "v < 3", quality.FAIL)]).collect()
    with pytest.raises(ValueError):
        quality.Expectation("x", "true", "ignore")


def test_fail_rule_sees_only_rows_that_reach_it(spark):
    left = spark.createDataFrame([(1, -5), (2, 5)], "k int, v int")
    joined = left.join(spark.createDataFrame([(2,)], "k int"), "k")
    assert quality.keep_expected(joined, [quality.Expectation("positive", "v > 0", quality.FAIL)]).count() == 1
    assert quality.keep_expected(left.filter("k > 1"), [quality.Expectation("positive", "v > 0", quality.FAIL)]).collect() == [(2, 5)]


def test_fail_rule_leaves_no_files(spark, folder):
    from millrace import storage

    with pytest.raises(quality.ExpectationFailed):
        quality.write_expected(spark.range(5), [quality.Expectation("none", "id < 4", quality.FAIL)], folder, "d")
    assert not storage.exists(spark, folder)


def test_protection(spark):
    df = spark.createDataFrame([(1, "abcd"), (40, "efgh")], "id int, s string")
    groups = protect.groups_of(spark.createDataFrame([("u", "g"), ("v", "h")], "user_name string, group_name string"), "u")
    assert groups == {"g"}
    assert [r["s"] for r in protect.redact(df, ["s"], "g" in groups).collect()] == ["REDACTED"] * 2
    assert [r["s"] for r in protect.redact(df, ["s"], False).collect()] == ["abcd", "efgh"]
    assert [r["s"] for r in protect.mask_columns(df, ["s"]).collect()] == ["**cd", "**gh"]
    assert [r["id"] for r in protect.filter_rows(df, True, "id < 30").collect()] == [1]
    assert protect.filter_rows(df, False, "id < 30").count() == 2


def test_time_folders_with_bare_numbers(spark, folder):
    for name, value in (("2023/12/31/23/59", 0), ("2024/9/05/1/00", 1), ("2024/10/1/00/30", 2), ("2024/10/01/00/31", 3), ("2025/1/1/0/0", 4)):
        spark.createDataFrame([(value,)], "v int").coalesce(1).write.parquet(f"{folder}/{name}")

    def read(*args):
        return sorted(r["v"] for r in timefolders.read_time_range(spark, folder, *args).collect())

    assert read(datetime(2024, 9, 5, 1), datetime(2024, 10, 1, 0, 31)) == [1, 2]
    assert read(datetime(2023, 12, 31, 23, 59, 30), datetime(2025, 1, 1, 0, 1)) == [0, 1, 2, 3, 4]
    assert read(datetime(2024, 10, 1, 0, 30), datetime(2024, 10, 1, 0, 31, 59)) == [2]
    assert timefolders.read_time_range(spark, folder, datetime(2020, 1, 1), datetime(2020, 1, 2), schema="v int").isEmpty()
    assert timefolders.latest_folder_time(spark, folder).first()[0] == datetime(2025, 1, 1)
    with pytest.raises(ValueError):
        read(datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 30))


def test_jdbc_bounds_are_checked(spark):
    for bad in ((5, 5, 4), (0, 10, 0)):
        with pytest.raises(ValueError):
            jdbc.read_partitioned(spark, "jdbc:none:", "t", "id", *bad)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from millrace.session import scratch

    def fake(master, folder):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(master=master))

    with pytest.raises(ValueError, match="checkpoint"):
        scratch(fake("yarn", None), "x")
    assert scratch(fake("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")


def test_sql_function_describes_itself(spark):
    from millrace.functions.udfs import define_sql_function

    define_sql_function(spark, "twice_as_much", "x INT", "INT", "x * 2")
    assert spark.sql("SELECT twice_as_much(4)").first()[0] == 8
    assert "twice_as_much" in "\n".join(r[0] for r in spark.sql("DESCRIBE FUNCTION twice_as_much").collect())


def test_time_folders_keep_data_columns(spark, folder):
    df = spark.createDataFrame([(1, "kept"), (2, "too")], "id int, d string")
    df.write.parquet(f"{folder}/2024/2/10/0/0")
    df.write.parquet(f"{folder}/2024/10/9/0/0")
    got = timefolders.read_time_range(spark, folder, datetime(2024, 1, 1), datetime(2025, 1, 1))
    assert got.columns == ["id", "d"] and got.count() == 4
    assert timefolders.latest_folder_time(spark, folder).first()[0] == datetime(2024, 10, 9)
