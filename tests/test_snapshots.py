import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.merge import DuplicateSourceRows, when_matched_delete, when_matched_update, when_not_matched_insert
from millrace import storage
from millrace.operators import merge
from millrace.operators.snapshots import ConstraintViolated, SchemaMismatch, SnapshotTable, with_generated

STUDENT = "id int, name string, value double"
BEAN = "name string, color string, grams float, delicious boolean"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def students(spark, folder):
    t = SnapshotTable(spark, folder)
    t.create(spark.createDataFrame([(1, "Yve", 1.0)], STUDENT))
    t.append(spark.createDataFrame([(2, "Omar", 2.5)], STUDENT))
    t.append(spark.createDataFrame([(3, "Elia", 3.3)], STUDENT))
    t.append(spark.createDataFrame([(4, "Ted", 4.7), (5, "Tiffany", 5.5), (6, "Vini", 6.3)], STUDENT).coalesce(1))
    t.update("name LIKE 'T%'", {"value": "value + 1"})
    t.delete("value > 6")
    return t


def student_updates(spark):
    data = [(2, "Omar", 15.2, "update"), (3, "", None, "delete"), (7, "Blue", 7.7, "insert"), (11, "Diya", 8.8, "update")]
    return spark.createDataFrame(data, STUDENT + ", type string")


CLAUSES = [when_matched_update("s.type = 'update'"), when_matched_delete("s.type = 'delete'"), when_not_matched_insert("s.type = 'insert'")]
END = [(1, "Yve", 1.0), (2, "Omar", 15.2), (4, "Ted", 5.7), (7, "Blue", 7.7)]


def test_students(spark, students):
    students.merge(student_updates(spark), "id", CLAUSES)
    assert rows(students.read()) == END
    assert [r["operation"] for r in students.history().orderBy("version").collect()] == [
        "CREATE OR REPLACE", "APPEND", "APPEND", "APPEND", "UPDATE", "DELETE", "MERGE"
    ]
    assert students.read(version=3).count() == 6


def test_merge_twice_is_merge_once(spark, students):
    updates = student_updates(spark).filter("type <> 'insert'")
    students.merge(updates, "id", CLAUSES)
    once = rows(students.read())
    students.merge(updates, "id", CLAUSES)
    assert rows(students.read()) == once


def test_beans(spark, folder):
    t = SnapshotTable(spark, folder)
    t.create(spark.createDataFrame([("black", "black", 500.0, True), ("lentils", "brown", 1000.0, True), ("jelly", "rainbow", 42.5, False)], BEAN))
    t.append(spark.createDataFrame([("pinto", "brown", 1.5, True), ("green", "green", 178.3, True), ("beanbag chair", "white", 40000.0, False)], BEAN))
    t.update("name = 'jelly'", {"delicious": "true"})
    t.update("name = 'pinto'", {"grams": "1500"})
    t.delete("delicious = false")
    new = [("black", "black", 60.5, True), ("lentils", "green", 500.0, True), ("kidney", "red", 387.2, True), ("castor", "brown", 25.0, False)]
    t.merge(
        spark.createDataFrame(new, BEAN), "name, color",
        [when_matched_update(set={"grams": "t.grams + s.grams"}), when_not_matched_insert("s.delicious = true")],
    )
    grams = {(r["name"], r["color"]): round(r["grams"], 1) for r in t.read().collect()}
    assert grams == {
        ("black", "black"): 560.5, ("lentils", "brown"): 1000.0, ("jelly", "rainbow"): 42.5, ("pinto", "brown"): 1500.0,
        ("green", "green"): 178.3, ("lentils", "green"): 500.0, ("kidney", "red"): 387.2,
    }


def test_null_conditions_do_not_match(spark, folder):
    t = SnapshotTable(spark, folder)
    t.create(spark.createDataFrame([(1, None), (2, 5)], "id int, v int"))
    t.delete("v > 1")
    assert rows(t.read()) == [(1, None)]
    t.merge(spark.createDataFrame([(1, 9)], "id int, v int"), "id", [when_matched_delete("t.v > s.v"), when_matched_update("s.v > 100")])
    assert rows(t.read()) == [(1, None)]


def test_two_source_rows_for_one_target_row(spark, folder):
    t = SnapshotTable(spark, folder)
    t.create(spark.createDataFrame([(1, "a")], "id int, v string"))
    twice = spark.createDataFrame([(1, "b"), (1, "c"), (2, "d"), (2, "e")], "id int, v string")
    with pytest.raises(DuplicateSourceRows):
        t.merge(twice, "id", [when_matched_update(), when_not_matched_insert()])
    assert t.version() == 0
    t.merge(twice.filter("id = 2"), "id", [when_matched_update(), when_not_matched_insert()])
    assert rows(t.read()) == [(1, "a"), (2, "d"), (2, "e")]


def test_null_keys(spark, folder):
    schema = "k string, v int"
    source = spark.createDataFrame([(None, 2)], schema)
    clauses = [when_matched_update(), when_not_matched_insert()]
    for null_safe, expected in ((True, [(None, 2)]), (False, [(None, 1), (None, 2)])):
        t = SnapshotTable(spark, f"{folder}-{null_safe}")
        t.create(spark.createDataFrame([(None, 1)], schema))
        t.merge(source, "k", clauses, null_safe=null_safe)
        assert sorted(t.read().collect(), key=lambda r: r["v"]) == expected


def test_many_target_rows_for_one_source_row(spark, folder):
    t = SnapshotTable(spark, folder)
    t.create(spark.range(1000).selectExpr("if(id < 900, 0, id) AS k", "id AS v"))
    t.merge(spark.createDataFrame([(0, -1), (5000, 7)], "k long, v long"), ["k"], [when_matched_update(), when_not_matched_insert()])
    assert t.read().filter("k = 0 AND v = -1").count() == 900
    assert t.read().count() == 1001


def test_update_uses_old_values(spark, folder):
    t = SnapshotTable(spark, folder)
    t.create(spark.createDataFrame([(1, 2)], "a int, b int"))
    t.update("true", {"a": "b", "b": "a"})
    assert rows(t.read()) == [(2, 1)]


def test_change_rewrites_only_touched_parts(spark, students):
    before = {p["path"] for p in students._entry()["parts"]}
    students.update("id = 1", {"value": "100"})
    after = {p["path"] for p in students._entry()["parts"]}
    assert len(before - after) == 1 and len(after - before) == 1
    students.update("id = 12345", {"value": "100"})
    assert {p["path"] for p in students._entry()["parts"]} == after


def test_partitions(spark, folder):
    t = SnapshotTable(spark, folder)
    t.create(spark.range(99).selectExpr("id", "concat(id % 3, ' a:%/b') AS k"), partition_by=["k"])
    kept = {p["path"] for p in t._entry()["parts"]}
    t.delete("k = '1 a:%/b' AND id < 50")
    assert len(kept & {p["path"] for p in t._entry()["parts"]}) == 2
    t.overwrite_partitions(spark.createDataFrame([(500, "2 a:%/b")], "id long, k string"))
    assert {r["k"]: r["count"] for r in t.read().groupBy("k").count().collect()} == {"0 a:%/b": 33, "1 a:%/b": 16, "2 a:%/b": 1}


def test_schema_is_enforced(spark, students):
    for bad in ("id int, name string", "id int, name string, value double, extra int", "id long, name string, value double"):
        with pytest.raises(SchemaMismatch):
            students.append(spark.createDataFrame([], bad))
        with pytest.raises(SchemaMismatch):
            students.overwrite(spark.createDataFrame([], bad))


def test_evolution_keeps_old_rows(spark, students):
    wide = spark.createDataFrame([(1, "Yve", 9.0, "x"), (50, "New", 1.0, "y")], STUDENT + ", note string")
    students.merge(wide, "id", [when_matched_update(), when_not_matched_insert()], evolve=True)
    got = {r["id"]: r["note"] for r in students.read().collect()}
    assert got == {1: "x", 2: None, 3: None, 4: None, 50: "y"}
    assert students.read(version=3).columns == ["id", "name", "value"]


def test_constraints_and_generated_columns(spark, folder):
    t = SnapshotTable(spark, folder)
    t.create(spark.range(5), constraints={"small": "id < 100"}, generated={"double_id": "id * 2"})
    with pytest.raises(ConstraintViolated, match="small"):
        t.append(spark.range(99, 103))
    assert t.version() == 0
    t.append(spark.createDataFrame([(None,)], "id long"))  # NULL passes a CHECK
    with pytest.raises(ConstraintViolated):
        t.update("id = 3", {"id": "300"})
    with pytest.raises(Exception, match="generated column"):
        with_generated(spark.range(1).withColumn("x", F.lit(7)), {"x": "cast(id AS INT)"}).collect()


def test_tagged_append_happens_once(spark, students):
    n = students.read().count()
    for _ in range(2):
        students.append(spark.createDataFrame([(77, "Z", 1.0)], STUDENT), tag="batch-1")
    assert students.read().count() == n + 1


def test_travel_restore_clone_expire(spark, students, folder):
    as_of = students.history().filter("version = 3").first()["committed_at"]
    assert rows(students.read(as_of=as_of)) == rows(students.read(version=3))
    files_before = students.usage().first()
    students.restore(3)
    assert students.read().count() == 6 and files_before is not None
    shallow, deep = students.clone(f"{folder}-s", deep=False), students.clone(f"{folder}-d")
    shallow.delete("id = 1")
    deep.delete()
    assert (shallow.read().count(), deep.read().count(), students.read().count()) == (5, 0, 6)
    with pytest.raises(ValueError, match="7 days"):
        students.expire(retain=timedelta(hours=0))
    listed = students.expire(retain=timedelta(0), force=True)
    assert {r["part"].split("-")[0] for r in listed.collect()} == {"millrace_version=4", "millrace_version=5"}
    students.expire(retain=timedelta(0), force=True, dry_run=False)
    assert students.read().count() == 6


def test_compaction_spreads_a_hot_key(spark, folder):
    t = SnapshotTable(spark, folder)
    t.create(spark.range(20000).selectExpr("if(id < 18000, 1, id) AS k", "id").repartition(20))
    t.compact(["k"], files=4)
    largest = max(r["count"] for r in t.read().groupBy(F.col("_metadata.file_path")).count().collect())
    assert t.read().count() == 20000 and largest < 10000


def test_compaction_sorts_large_files_in_stretches(spark, folder, monkeypatch):
    """A task sorts no more than a stretch of a file, and the files are as if each had been sorted whole."""
    t, sorted_by_a_task = SnapshotTable(spark, folder), []

    def delete(spark, path, real=storage.delete):
        files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()
        sorted_by_a_task.extend(r["count"] for r in files)
        return real(spark, path)

    t.create(spark.range(20000).selectExpr("nullif(id * 7919 % 5000, 0) AS k", "id").repartition(20))
    monkeypatch.setattr("millrace.operators.snapshots.SORT_ROWS", 1000, raising=False)
    monkeypatch.setattr(storage, "delete", delete)
    t.compact(["k"], files=4)
    assert rows(t.read().select("id")) == [(i,) for i in range(20000)]
    assert len(sorted_by_a_task) > 16 and max(sorted_by_a_task) < 2500 and not storage.file_names(spark, f"{folder}/staging")
    ranges = sorted((r["low_k"], r["high_k"], r["rows"]) for r in t.file_ranges(["k"]).collect())
    assert len(ranges) == 4 and max(r[2] for r in ranges) < 8000 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    for part in t.parts():
        keys = [r["k"] for r in t.read_parts([part]).coalesce(1).collect()]
        assert keys == sorted(keys, key=lambda k: (k is not None, k))


def test_second_writer_of_a_version_is_refused(spark, students):
    entry = students._entry()
    students.append(spark.createDataFrame([(77, "Z", 1.0)], STUDENT))
    rows = sorted(students.read().collect())
    with pytest.raises(FileExistsError):
        students._again(entry, "APPEND", None, entry["parts"])
    with pytest.raises(FileExistsError):
        students._again(entry, "APPEND", spark.createDataFrame([(78, "Y", 2.0)], STUDENT), entry["parts"])
    assert sorted(students.read().collect()) == rows
    assert len([n for n in storage.file_names(spark, f"{students.root}/data") if "-" in n]) == len({p["path"].split("/")[0] for e in range(students.version() + 1) for p in students._entry(e)["parts"]})


def test_an_expired_version_is_not_restored(spark, folder):
    t = SnapshotTable(spark, folder)
    t.create(spark.range(5).toDF("id"))
    t.overwrite(spark.range(9).toDF("id"))
    t.expire(retain=timedelta(0), dry_run=False, force=True)
    with pytest.raises(ValueError, match="expired"):
        t.restore(0)
    assert t.read().count() == 9


def test_missing_version(spark, students):
    with pytest.raises(ValueError, match="no version"):
        students.read(version=99)


# ---- files and key index ------------------------------------------------------------------------


def eight_files(spark, folder, **options):
    t = SnapshotTable(spark, folder)
    rows = spark.range(8000).select(F.col("id").alias("k"), F.concat(F.lit("n"), (F.col("id") * 7919 % 8000).cast("string")).alias("name"), F.lit(0).alias("v"))
    t.create(rows.repartition(8), **options)
    return t


def paths(t):
    return {p["path"] for p in t.parts()}


@pytest.mark.parametrize("keys", [["k"], ["k", "name"], ["name"]])
def test_a_merge_of_one_row_reads_and_writes_one_file(spark, folder, keys):
    t = eight_files(spark, folder, index_by=keys)
    before = paths(t)
    source = spark.createDataFrame([(4711, "n" + str(4711 * 7919 % 8000), 5)], "k long, name string, v int")
    near = t._may_hold(t._entry(), source, keys)
    assert len(near) == 1  # nothing of the other seven files is read
    t.merge(source, keys, [when_matched_update()])
    assert len(before) == 8 and len(before - paths(t)) == 1 and len(paths(t) - before) == 1
    assert t.read().filter("v = 5").collect() == source.collect() and t.read().count() == 8000


def test_an_index_loses_no_match(spark, folder):
    plain, indexed = eight_files(spark, f"{folder}/a"), eight_files(spark, f"{folder}/b", index_by=["k"])
    source = spark.range(7000, 9000, 3).select(F.col("id").alias("k"), F.lit("new").alias("name"), F.lit(1).alias("v"))
    for t in (plain, indexed):
        t.merge(source, "k", [when_matched_update(), when_not_matched_insert()])
        t.append(spark.createDataFrame([(None, "x", 3)], "k long, name string, v int"))
        t.delete("k % 5 = 0")
        t.merge(spark.createDataFrame([(None, "null", 9), (1, "one", 9)], "k long, name string, v int"), "k", [when_matched_update(), when_not_matched_insert()], null_safe=True)
    assert sorted(map(str, plain.read().collect())) == sorted(map(str, indexed.read().collect()))
    assert indexed.read().filter("name = 'null'").count() == 1
    indexed.restore(0)
    assert indexed._may_hold(indexed._entry(), spark.createDataFrame([(99_999,)], "k long"), ["k"]) == []


def test_update_and_delete_rewrite_touched_files_only(spark, folder):
    t = eight_files(spark, folder)
    before = paths(t)
    t.update("k = 17", {"v": "1"})
    assert len(before & paths(t)) == 7
    t.delete("k = 18")
    assert len(before & paths(t)) == 6 and t.read().count() == 7999


def test_tags_of_writers_stay_in_the_newest_entry(spark, folder):
    t = SnapshotTable(spark, folder)
    t.create(spark.range(1), tag="a:0")
    t.append(spark.range(1), tag="a:1")
    t.append(spark.range(1), tag="once")
    t.append(spark.range(1), tag="a:0")
    assert t.read().count() == 3 and t.has_tag("a:1") and t.has_tag("once") and not t.has_tag("a:2") and not t.has_tag("b:0")
    assert t._entry()["tags"] == {"a": 1, "once": 0}


def test_clustering_along_a_curve(spark, folder):
    t = SnapshotTable(spark, folder)
    rows = spark.range(6000).select((F.col("id") * 7919 % 6000).alias("a"), (F.col("id") * 104729 % 6007).cast("double").alias("b"), F.concat(F.lit("s"), F.col("id") % 5).alias("c"))
    rows = rows.unionAll(spark.createDataFrame([(None, None, None), (1, float("nan"), "s")], rows.schema))
    t.create(rows)
    before = sorted(map(str, t.read().collect()))
    met = {}
    for together in (False, True):
        t.compact(["a", "b"], files=16, together=together)
        ranges = t.file_ranges(["a", "b"])
        met[together] = [ranges.filter(f"low_{k} <= 700 AND high_{k} >= 500").count() for k in "ab"]
        assert sorted(map(str, t.read().collect())) == before and len(t.parts()) == 16
    assert met[False][1] == 16 and met[True][1] <= 8 and met[True][0] <= 8
    t.compact(["a", "b", "c"], files=4, together=True)
    assert sorted(map(str, t.read().collect())) == before


def test_appends_widen_the_schema(spark, folder):
    t = SnapshotTable(spark, folder)
    t.create(spark.createDataFrame([(1, (2,))], "a int, s struct<x: int>"))
    wide = spark.createDataFrame([(3, (4, "y"), 0.5)], "a int, s struct<x: int, y: string>, b double")
    with pytest.raises(SchemaMismatch):
        t.append(wide)
    t.append(wide, evolve=True)
    assert sorted((r.a, r.s.x, r.s.y, r.b) for r in t.read().collect()) == [(1, 2, None, None), (3, 4, "y", 0.5)]
    with pytest.raises(SchemaMismatch):
        t.append(spark.createDataFrame([("x",)], "a string"), evolve=True)


def test_a_merge_of_many_rows_broadcasts_neither_them_nor_filters(spark, folder, monkeypatch):
    """What a broadcast holds passes through the driver; small files can hold very many rows."""
    plans, joined = [], []

    def collect(df, real=type(spark.range(1)).collect):
        found = real(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return found

    def matched_rows(*args, real=merge.matched_rows):
        df = real(*args)
        joined.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    t = SnapshotTable(spark, folder)
    t.create(spark.range(0, 4000, 1, 4).selectExpr("id AS k", "0 AS v"), index_by=["k"])
    monkeypatch.setattr(merge, "MOST_SENT", 100, raising=False)
    monkeypatch.setattr(merge, "matched_rows", matched_rows)
    monkeypatch.setattr(type(spark.range(1)), "collect", collect)
    source = spark.range(0, 8000, 4).selectExpr("if(id % 8 = 0, id, id + 100000) AS k", "1 AS v")
    t.merge(source, "k", [when_matched_update(), when_not_matched_insert()])
    tests = [p for p in plans if "bitmap" in p and "Join" in p]
    assert tests and not any(re.search(r"BroadcastHashJoin \[(bits|key|piece)", p) for p in tests)
    assert "SortMergeJoin" in joined[0] and "BroadcastHashJoin" not in joined[0]
    monkeypatch.undo()
    want = [(k, int(k % 8 == 0)) for k in range(4000)] + [(k, 1) for k in range(4000, 8000, 8)] + [(k + 100000, 1) for k in range(4, 8000, 8)]
    assert rows(t.read()) == sorted(want)
    t.merge(spark.createDataFrame([(1, 9)], "k long, v int"), "k", [when_matched_update()])
    assert rows(t.read().filter("k = 1")) == [(1, 9)]


@pytest.mark.parametrize("many", [False, True])
def test_large_and_small_sources_are_joined_alike(spark, folder, monkeypatch, many):
    """Null keys, keys in common and repeated ones, by either join."""
    monkeypatch.setattr(merge, "MOST_SENT", 0 if many else 100_000, raising=False)
    t = SnapshotTable(spark, folder)
    t.create(spark.createDataFrame([(None, "a"), (1, "b"), (2, "c"), (2, "d"), (3, "e")], "k long, v string"), index_by=["k"])
    source = spark.createDataFrame([(None, "A"), (2, "C"), (4, "D"), (4, "E")], "k long, v string")
    t.merge(source, "k", [when_matched_update(), when_not_matched_insert()])
    assert sorted(map(tuple, t.read().collect()), key=str) == sorted([(None, "a"), (None, "A"), (1, "b"), (2, "C"), (2, "C"), (3, "e"), (4, "D"), (4, "E")], key=str)
    with pytest.raises(DuplicateSourceRows):
        t.merge(source, "k", [when_matched_update()])
    t.merge(source.limit(1), "k", [when_matched_delete()], null_safe=True)
    assert t.read().filter("k IS NULL").count() == 0
