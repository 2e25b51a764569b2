import random
from datetime import datetime, timedelta, timezone

import pytest

from millrace.operators.loads import LoadArea, compare_schemas, next_schema_version
from millrace.operators.merge import split_keys
from millrace.sources.loader import load, parse_envelope, read_schema


def when(n):
    return datetime(2024, 5, n, tzinfo=timezone.utc)


def ints(spark, *names):
    return spark.createDataFrame([tuple(random.randrange(100) for _ in names) for _ in range(10)], ", ".join(f"{n} int" for n in names))


def test_overwrites_with_two_three_two_columns(spark, folder):
    area = LoadArea(spark, folder)
    versions = [
        area.write(ints(spark, *names), "t", "overwrite", "full", when(i + 1))
        for i, names in enumerate([("col1", "col2"), ("col1", "col2", "col3"), ("col2", "col3")])
    ]
    assert versions == ["v_001", "v_002", "v_002"]
    last = area.table("t").read()
    assert last.columns == ["col1", "col2", "col3"] and last.filter("col1 IS NOT NULL").isEmpty()
    assert area.last_load_date("t").replace(tzinfo=timezone.utc) == when(3)


def test_append_and_merge_need_keys_and_a_table(spark, folder):
    area = LoadArea(spark, folder)
    with pytest.raises(ValueError, match="primary_keys"):
        area.write(ints(spark, "a"), "t", "append", "delta", when(1))
    with pytest.raises(ValueError, match="does not exist"):
        area.write(ints(spark, "a"), "t", "merge", "delta", when(1), "a")
    with pytest.raises(ValueError, match="unknown"):
        area.write(ints(spark, "a"), "t", "upsert", "delta", when(1), "a")


def test_rollback_without_earlier_version(spark, folder):
    area = LoadArea(spark, folder)
    area.write(ints(spark, "a"), "t", "overwrite", "full", when(1))
    assert area.rollback("t", "full", when(2)) is None
    assert area.quality_gate({"other": "full"}, "t", when(2)) == -1
    assert area.quality_gate({"t": "delta"}, "t", when(2)) == 0
    assert area.high_watermark("none", "a") is None


def test_schema_comparison(spark):
    held, extract = ints(spark, "a", "b"), ints(spark, "b", "c")
    got = compare_schemas(held, extract)
    assert (got.valid, set(got.columns), got.new, got.dropped) == (False, {"a", "c"}, ("c",), ("a",))
    assert compare_schemas(held, ints(spark, "a")).valid
    text = held.withColumn("a", held.a.cast("string"))
    assert compare_schemas(held, text).valid and not compare_schemas(held, text, check_types=True).valid


def test_names():
    assert next_schema_version("v_009") == "v_010"
    assert split_keys("a, b") == ["a", "b"]
    with pytest.raises(ValueError):
        split_keys(" , ")


def test_loader_refuses_what_it_cannot_read(spark, folder):
    with pytest.raises(ValueError, match="unsupported"):
        load(spark, folder, "docx")
    for kind in ("avro", "xlsx", "delta"):
        with pytest.raises(ValueError, match="connector"):
            load(spark, folder, kind)
    assert read_schema(spark, folder) is None


def test_envelope_types_come_from_all_rows(spark):
    bodies = ['{"a": 1, "b": {"c": "x"}, "e": null}', '{"a": 2, "d": [1.5]}', '{"a": 3, "b": {"f": true}, "mixed": 1}', '{"mixed": "x"}', "broken"]
    df = parse_envelope(spark.createDataFrame([(b,) for b in bodies], "Body string"), "Body")
    types = dict(df.dtypes)
    assert types == {"a": "bigint", "b": "struct<c:string,f:boolean>", "d": "array<double>", "e": "string", "mixed": "string"}
    assert sorted(r["a"] for r in df.collect() if r["a"]) == [1, 2, 3]


def test_schema_versions_are_compared_by_number(spark, folder):
    area = LoadArea(spark, folder)
    for n, version in enumerate(("v_999", "v_1000", "v_998")):
        area.table("t", version).create(spark.range(1).toDF("id"))
        area.log("t", "overwrite", "full", datetime(2024, 1, 1 + n, tzinfo=timezone.utc), version)
    assert area.last_schema_version("t") == "v_1000" and next_schema_version("v_999") == "v_1000"


def test_gate_after_an_empty_load_that_began_a_schema_version(spark, folder):
    area = LoadArea(spark, folder)
    area.write(spark.createDataFrame([(1, 2)], "a int, b int"), "t", "overwrite", "full", when(1))
    area.write(spark.createDataFrame([], "a int, c int"), "t", "overwrite", "full", when(2))
    assert area.last_schema_version("t") == "v_002"
    assert area.quality_gate({"t": "full"}, "t", when(3)) == 1
    assert area.last_schema_version("t") == "v_001" and [tuple(r) for r in area.table("t").read().collect()] == [(1, 2)]
    assert area.write(spark.createDataFrame([(3, 4)], "a int, c int"), "t", "overwrite", "full", when(4)) == "v_002"
    assert [tuple(r) for r in area.table("t").read().collect()] == [(3, 4)]


def test_gate_without_anything_to_go_back_to(spark, folder):
    area = LoadArea(spark, folder)
    area.write(spark.createDataFrame([], "a int"), "t", "overwrite", "full", when(1))
    assert area.quality_gate({"t": "full"}, "t", when(2)) == 2


def test_loads_expire_their_old_versions(spark, folder, monkeypatch):
    monkeypatch.setattr(LoadArea, "EXPIRE_EVERY", 3)
    area = LoadArea(spark, folder, retain=timedelta(0))
    for n in range(3):
        area.write(spark.createDataFrame([(n,)], "a int").coalesce(1), "t", "overwrite", "full", when(n + 1))
    with pytest.raises(ValueError, match="expired"):
        area.table("t").restore(0)
    assert area.table("t").read(version=1).collect()[0]["a"] == 1 and area.table("t").read().collect()[0]["a"] == 2
