"""Tables kept up by runs, aggregates by differences, and joins of streams in bounded state."""

import math
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators.snapshots import SnapshotTable
from millrace.session import scratch
from millrace.streaming import aggregates as A
from millrace.streaming.changes import ChangeTable
from millrace.streaming.joins import interval_join

QUIET = [HealthCheck.function_scoped_fixture]


# ---- runs ---------------------------------------------------------------------------------------


def changes(spark, rows):
    return spark.createDataFrame(rows, "k long, seq long, v string")


def files_by_bucket(t):
    return {b: {p["path"] for run in runs for p in run} for b, runs in t.runs().items()}


def test_a_fold_leaves_other_buckets_alone(spark):
    t = ChangeTable(spark, scratch(spark, "changes"), ["k"], "seq", except_columns=["seq"], compact_every=2, buckets=4)
    t.apply(changes(spark, [(k, 1, f"a{k}") for k in range(200)]))
    first = files_by_bucket(t)
    assert len(first) == 4
    for seq in (2, 3, 4):
        t.apply(changes(spark, [(7, seq, f"b{seq}")]))
    after = files_by_bucket(t)
    touched = [b for b in first if after[b] != first[b]]
    assert len(touched) == 1 and all(first[b] == after[b] for b in first if b != touched[0])
    assert first[touched[0]] <= after[touched[0]]  # the large run is not rewritten for three rows
    assert len(t.runs()[touched[0]]) < 4  # but the small ones were folded
    rows = {r.k: r.v for r in t.current().collect()}
    assert rows == {k: "b4" if k == 7 else f"a{k}" for k in range(200)}


def test_a_read_combines_only_buckets_with_several_runs(spark):
    t = ChangeTable(spark, scratch(spark, "changes"), ["k"], "seq", compact_every=0, buckets=4)
    t.apply(changes(spark, [(k, 1, "a") for k in range(50)]))
    assert "Aggregate" not in t.current()._jdf.queryExecution().executedPlan().toString()
    t.apply(changes(spark, [(7, 2, "b")]))
    alone = sum(len(runs) == 1 for runs in t.runs().values())
    assert alone == 3 and t.current().count() == 50
    t.compact()
    assert all(len(runs) == 1 for runs in t.runs().values()) and t.current().filter("v = 'b'").count() == 1
    version = t.table.version()
    t.compact()
    assert t.table.version() == version  # nothing left to fold


def test_rows_are_rewritten_logarithmically(spark):
    t = ChangeTable(spark, scratch(spark, "changes"), ["k"], "seq", except_columns=["seq"], compact_every=2, buckets=1)
    for i in range(8):
        t.apply(changes(spark, [(10 * i + j, 1, "x") for j in range(10)]), f"b:{i}")
    written = t.table.history().agg(F.sum("rows_added")).first()[0]
    assert t.current().count() == 80 and written <= 80 * (2 + math.log2(8))
    t.apply(changes(spark, [(1, 9, "late")]), "b:3")  # an old number of that writer
    assert t.current().filter("v = 'late'").isEmpty()


def test_old_versions_expire(spark, monkeypatch):
    monkeypatch.setattr("millrace.streaming.runs.EXPIRE_EVERY", 3)
    t = ChangeTable(spark, scratch(spark, "changes"), ["k"], "seq", compact_every=2, buckets=1, retain=timedelta(0))
    for i in range(6):
        t.apply(changes(spark, [(i, 1, "x")]))
    with pytest.raises(Exception, match="expired|exist"):
        t.table.restore(0)
    assert t.current().count() == 6


# ---- aggregates ---------------------------------------------------------------------------------

STATS = {
    "n": A.Aggregate(A.COUNT), "known": A.Aggregate(A.COUNT, "v"), "total": A.Aggregate(A.SUM, "v"), "mean": A.Aggregate(A.AVG, "v"),
    "low": A.Aggregate(A.MIN, "v"), "high": A.Aggregate(A.MAX, "v"),
}


def expected(rows):
    out = {}
    for k, v in rows:
        out.setdefault(k, []).append(v)
    result = {}
    for k, values in out.items():
        known = [v for v in values if v is not None]
        some = (sum(known), sum(known) / len(known), min(known), max(known)) if known else (None,) * 4
        result[k] = (len(values), len(known), *some)
    return result


def got(frame):
    return {r.k: (r.n, r.known, r.total, r.mean, r.low, r.high) for r in frame.collect()}


ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(-5, 5))), max_size=12)


@settings(max_examples=3, deadline=None, suppress_health_check=QUIET)
@given(st.lists(ROWS, min_size=1, max_size=4))
def test_states_merge_to_the_aggregate(spark, batches):
    t = A.AggregateTable(spark, scratch(spark, "aggregate"), ["k"], STATS, buckets=2, fan=2)
    for i, rows in enumerate(batches):
        batch = spark.createDataFrame(rows, "k long, v long")
        t.apply(batch, f"s:{i}")
        t.apply(batch, f"s:{i}")  # comes again
    assert got(t.current()) == expected([r for rows in batches for r in rows])


def test_a_batch_of_one_group_adds_one_file(spark):
    t = A.AggregateTable(spark, scratch(spark, "aggregate"), ["k"], STATS, buckets=4)
    t.apply(spark.createDataFrame([(k, k) for k in range(100)], "k long, v long"))
    before = {p["path"] for p in t.table.parts()}
    t.apply(spark.createDataFrame([(5, 1)] * 50, "k long, v long"))
    after = {p["path"] for p in t.table.parts()}
    assert before < after and len(after - before) == 1 and got(t.current())[5] == (51, 51, 55, 55 / 51, 1, 5)


def test_distinct_counts_are_united_from_states(spark):
    t = A.AggregateTable(spark, scratch(spark, "aggregate"), ["day"], {"users": A.Aggregate(A.DISTINCT, "u")})
    t.apply(spark.range(30_000).select((F.col("id") % 10).alias("day"), (F.col("id") % 4000).alias("u")))
    estimate = t.by(F.lit("all").alias("range"), where="day < 5").first()
    exact = len({i % 4000 for i in range(30_000) if i % 10 < 5})
    assert estimate["range"] == "all" and abs(estimate.users - exact) < 0.03 * exact
    text = t.by(F.lit(1).alias("one"))._jdf.queryExecution().optimizedPlan().toString()
    assert "hll_union_agg" in text and "hll_sketch_agg" not in text  # no rows are read again


def test_kinds_are_checked():
    with pytest.raises(ValueError):
        A.Aggregate("median", "v")
    with pytest.raises(ValueError):
        A.Aggregate(A.SUM)


def maintained(spark, rows, **options):
    source = SnapshotTable(spark, scratch(spark, "source"))
    source.create(spark.createDataFrame(rows, "id long, k long, v long"))
    return source, A.MaintainedAggregate(source, scratch(spark, "maintained"), ["k"], STATS, **options)


@settings(max_examples=3, deadline=None, suppress_health_check=QUIET)
@given(ROWS, ROWS, st.integers(0, 12), st.integers(-5, 5))
def test_differences_give_the_aggregate(spark, first, more, gone, limit):
    rows = [(i, *r) for i, r in enumerate(first)]
    source, kept_up = maintained(spark, rows, buckets=2)
    kept_up.refresh()
    now = lambda: expected([(r.k, r.v) for r in source.read().collect()])
    steps = [
        lambda: source.append(spark.createDataFrame([(100 + i, *r) for i, r in enumerate(more)], "id long, k long, v long")),
        lambda: source.delete(f"id < {gone}"),
        lambda: source.update(f"v >= {limit}", {"v": "v - 7", "k": "k + 1"}),
        lambda: source.delete("v IS NULL"),
    ]
    for step in steps:
        step()
        kept_up.refresh()
        assert got(kept_up.read()) == now()


def test_a_refresh_reads_and_writes_what_changed(spark):
    source, kept_up = maintained(spark, [(i, i % 40, i) for i in range(400)])
    assert kept_up.refresh() == len(source.parts()) and kept_up.refresh() == 0
    before = {p["path"] for p in kept_up.table.parts()}
    source.append(spark.createDataFrame([(1000, 3, 1)], "id long, k long, v long"))
    assert kept_up.refresh() == 1
    after = {p["path"] for p in kept_up.table.parts()}
    assert len(before - after) == 1 and len(after - before) == 1  # the bucket of that group
    assert got(kept_up.read())[3][0] == 11 and kept_up.refreshed_to() == source.version()


def test_a_refresh_after_expiry_starts_anew(spark):
    source, kept_up = maintained(spark, [(i, i % 3, i) for i in range(30)])
    kept_up.refresh()
    source.update("id < 20", {"v": "v + 1"})
    source.expire(retain=timedelta(0), force=True, dry_run=False)
    kept_up.refresh()
    assert got(kept_up.read()) == expected([(r.k, r.v) for r in source.read().collect()])


def test_a_condition_and_doubles(spark):
    source = SnapshotTable(spark, scratch(spark, "source"))
    source.create(spark.createDataFrame([(1, 1.5), (1, float("inf")), (2, float("nan")), (2, 1.0), (3, -1.0)], "k long, v double"))
    kept_up = A.MaintainedAggregate(source, scratch(spark, "maintained"), ["k"], {"total": A.Aggregate(A.SUM, "v")}, where="v > 0")
    kept_up.refresh()
    source.delete("v = double('inf')")
    source.delete("isnan(v)")
    kept_up.refresh()
    assert sorted(tuple(r) for r in kept_up.read().collect()) == [(1, 1.5), (2, 1.0)]


# ---- joins of streams ---------------------------------------------------------------------------

START = datetime(2024, 1, 1)


@pytest.fixture
def hourly(spark, folder):
    """Six files an hour apart, with rows of ten keys every minute."""

    def stream(name, shift):
        path = f"{folder}/{name}"
        for hour in range(6):
            rows = [(m % 10, f"{name}{hour}.{m}", START + timedelta(hours=hour, minutes=m, seconds=shift)) for m in range(0, 60, 1)]
            spark.createDataFrame(rows, f"k long, {name} string, {name}_at timestamp").coalesce(1).write.mode("append").parquet(path)
        schema = spark.read.parquet(path).schema
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path), spark.read.parquet(path)

    return stream("l", 0), stream("r", 30)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_drops_state(spark, folder, hourly, how):
    (left, all_left), (right, all_right) = hourly
    options = dict(keys=["k"], left_time="l_at", right_time="r_at", before="0 minutes", after="5 minutes", left_late="10 minutes", right_late="10 minutes")
    seen = []

    def keep(batch, _):
        seen.extend(tuple(r) for r in batch.collect())

    query = interval_join(left, right, how=how, **options).writeStream.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).foreachBatch(keep).start()
    query.awaitTermination()
    progress = [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]
    totals = [s.numRowsTotal for s in progress]
    assert sum(s.numRowsRemoved for s in progress) > 300 and len(totals) >= 6
    assert max(totals) <= 160 and totals[5] <= totals[2] + 10  # flat, while 720 rows came
    want = {tuple(r) for r in interval_join(all_left, all_right, how="inner", **options).collect()}
    assert {r for r in seen if r[3] is not None} == want and len(want) == 360
    assert how == "left" or all(r[3] is not None for r in seen)


def test_unmatched_rows_come_out_when_their_time_has_passed(spark, folder):
    def stream(name, times):
        for t in times:
            frame = spark.createDataFrame([(1, START + timedelta(hours=h)) for h in t], f"k long, {name} timestamp").coalesce(1)
            frame.write.mode("append").parquet(f"{folder}/{name}")
        return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{name}")

    joined = interval_join(stream("a", [[0, 5], [9], [40]]), stream("b", [[0.5], [9.5], [40]]), ["k"], "a", "b", "0 hours", "1 hour", how="left")
    joined.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()
    rows = sorted((r.a.hour, r.b is None) for r in spark.read.parquet(f"{folder}/out").collect() if r.a.day == 1)
    assert rows == [(0, False), (5, True), (9, False)]


def test_interval_join_checks_its_arguments(spark):
    a, b = spark.createDataFrame([(1, START, 1)], "k long, t timestamp, x long"), spark.createDataFrame([(1, START, 1)], "k long, u timestamp, x long")
    with pytest.raises(ValueError, match="both sides"):
        interval_join(a, b, ["k"], "t", "u", "1 hour", "1 hour")
    with pytest.raises(ValueError, match="inner or left"):
        interval_join(a, b.drop("x"), ["k"], "t", "u", "1 hour", "1 hour", how="full")
    assert interval_join(a, b.drop("x"), ["k"], "t", "u", "1 hour", "1 hour").columns == ["k", "t", "x", "u"]


def test_a_batch_compares_rows_near_in_time_only(spark, folder):
    """One busy key whose batch spans much more time than the range: its rows spread over tasks, at the ends of stretches too."""
    def stream(name, times):
        frame = spark.createDataFrame([(1, i, START + timedelta(minutes=m)) for i, m in enumerate(times)] + [(1, -1, None), (None, -2, START)], f"k long, {name} long, {name}_at timestamp")
        frame.coalesce(1).write.parquet(f"{folder}/{name}")
        return spark.readStream.schema(frame.schema).parquet(f"{folder}/{name}"), frame

    (left, all_left), (right, all_right) = stream("l", range(0, 3000, 7)), stream("r", range(0, 3000, 5))
    joined = interval_join(left, right, ["k"], "l_at", "r_at", "10 minutes", "20 minutes", long_batches=True)
    assert joined.columns == ["k", "l", "l_at", "r", "r_at"]
    got = []
    joined.withColumn("task", F.spark_partition_id()).writeStream.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).foreachBatch(lambda b, _: got.extend(b.collect())).start().awaitTermination()
    want = sorted((i, j) for i, a in enumerate(range(0, 3000, 7)) for j, b in enumerate(range(0, 3000, 5)) if -10 <= b - a <= 20)
    assert sorted((r.l, r.r) for r in got) == want and len({r.task for r in got}) > 4
    for before, after in (("10 minutes", "20 minutes"), ("-5 minutes", "20 minutes"), ("1 day", "0 days"), ("0 hours", "1 month")):
        near = f"r_at >= l_at - interval {before} and r_at <= l_at + interval {after}"
        for how in ("inner", "left"):
            plain = all_left.alias("a").join(all_right.alias("b"), F.expr(f"a.k = b.k and {near}"), how).select("l", "r")
            found = interval_join(all_left, all_right, ["k"], "l_at", "r_at", before, after, how=how, long_batches=True).select("l", "r")
            assert plain.exceptAll(found).isEmpty() and found.exceptAll(plain).isEmpty()


def test_days_of_a_zone_lose_no_pair(spark):
    """A day that the clock makes an hour longer or shorter."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        times = spark.range(0, 96 * 12).selectExpr("id", "timestamp'2024-03-08 12:00:00' + make_dt_interval(0, 0, id * 5) AS t")
        left, right = times.selectExpr("1 AS k", "id AS l", "t AS l_at"), times.filter("id % 7 = 0").selectExpr("1 AS k", "id AS r", "t AS r_at")
        plain = left.alias("a").join(right.alias("b"), F.expr("a.k = b.k and r_at >= l_at - interval 1 hour and r_at <= l_at + interval 1 day")).select("l", "r")
        found = interval_join(left, right, ["k"], "l_at", "r_at", "1 hour", "1 day", long_batches=True).select("l", "r")
        assert plain.exceptAll(found).isEmpty() and found.exceptAll(plain).isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
