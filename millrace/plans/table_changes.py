"""Changes to versioned tables: replace, append, update, delete, merge, travel, upkeep."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from millrace.functions.numbers import rounded_sum
from millrace.operators.merge import when_matched_delete, when_matched_update, when_not_matched_insert
from millrace.operators.snapshots import ConstraintViolated, SchemaMismatch, SnapshotTable
from millrace.plans.registry import query
from millrace.plans.sources import own_schema
from millrace.session import scratch
from millrace.streaming.datasets import copy_into
from millrace.tables import table


def snapshot(spark, df, **options):
    target = SnapshotTable(spark, scratch(spark, "snapshot"))
    target.create(df, **options)
    return target


def all_orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


def open_orders(spark, sf):
    """Targets of merges: the orders that changes may still find missing."""
    return all_orders(spark, sf).filter("o_totalprice < 250000")


def order_changes(spark, sf):
    """One change per order: its new status and price, and what to do with it."""
    return table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_linestatus").alias("o_orderstatus"), rounded_sum("l_extendedprice").alias("o_totalprice"),
        F.when(F.max("l_returnflag") == "A", "delete").when(F.min("l_returnflag") == "N", "insert").otherwise("update").alias("kind"),
    )


OPEN = "target as (select o_orderkey, o_orderstatus, o_totalprice from orders where o_totalprice < 250000)"
CHANGES = """source as (select l_orderkey as o_orderkey, max(l_linestatus) as o_orderstatus,
    round(sum(l_extendedprice), 2) as o_totalprice,
    case when max(l_returnflag) = 'A' then 'delete' when min(l_returnflag) = 'N' then 'insert' else 'update' end as kind from lineitem group by 1)"""


@query("tb_replace", "select o_orderkey, o_orderstatus, o_totalprice from orders")
def tb_replace(spark, sf):
    """Replacing may change the schema."""
    target = snapshot(spark, table(spark, sf, "orders").select("o_orderkey"))
    target.create(all_orders(spark, sf))
    return target.read()


@query("tb_overwrite_enforced", "select o_orderkey, o_orderstatus, o_totalprice * 2 as o_totalprice, true as refused from orders")
def tb_overwrite_enforced(spark, sf):
    orders = all_orders(spark, sf)
    target = snapshot(spark, orders)
    target.overwrite(orders.withColumn("o_totalprice", F.col("o_totalprice") * 2))
    try:
        target.overwrite(table(spark, sf, "orders"))
        refused = False
    except SchemaMismatch:
        refused = True
    return target.read().withColumn("refused", F.lit(refused))


@query("tb_append", "select o_orderkey, o_orderstatus, o_totalprice from orders where o_totalprice < 250000 union all select o_orderkey, o_orderstatus, o_totalprice from orders")
def tb_append(spark, sf):
    target = snapshot(spark, open_orders(spark, sf))
    target.append(table(spark, sf, "orders").select("o_totalprice", "o_orderkey", "o_orderstatus"))
    return target.read()


@query("tb_copy_into", "select o_orderstatus, count(*) as n from orders group by 1")
def tb_copy_into(spark, sf):
    """Three loads of a growing folder: files that were there before are not loaded again."""
    orders = table(spark, sf, "orders")
    folder, checkpoint = scratch(spark, "incoming"), scratch(spark, "checkpoint")
    target = SnapshotTable(spark, scratch(spark, "snapshot"))
    orders.filter("o_orderstatus = 'F'").write.parquet(folder)
    for _ in range(2):
        copy_into(spark, target, folder, "parquet", orders.schema, checkpoint)
    orders.filter("o_orderstatus <> 'F'").write.mode("append").parquet(folder)
    copy_into(spark, target, folder, "parquet", orders.schema, checkpoint)
    return target.read().groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("tb_update", "select c_custkey, c_name, case when c_mktsegment like 'M%' then c_acctbal + 1 else c_acctbal end as c_acctbal, c_mktsegment from customer")
def tb_update(spark, sf):
    target = snapshot(spark, table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))
    target.update("c_mktsegment LIKE 'M%'", {"c_acctbal": "c_acctbal + 1"})
    return target.read()


@query(
    "tb_delete",
    """select * from (select c_custkey, case when c_acctbal > 0 then c_acctbal end as c_acctbal from customer) where c_acctbal is null or c_acctbal <= 6000""",
)
def tb_delete(spark, sf):
    """Rows whose condition is NULL stay."""
    target = snapshot(spark, table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("c_acctbal")))
    target.delete("c_acctbal > 6000")
    return target.read()


@query(
    "tb_merge",
    f"""with {OPEN}, {CHANGES}
    select t.o_orderkey, case when s.kind = 'update' then s.o_orderstatus else t.o_orderstatus end as o_orderstatus,
        case when s.kind = 'update' then s.o_totalprice else t.o_totalprice end as o_totalprice
    from target t left join source s on t.o_orderkey = s.o_orderkey where s.kind is distinct from 'delete'
    union all
    select o_orderkey, o_orderstatus, o_totalprice from source where kind = 'insert' and o_orderkey not in (select o_orderkey from target)""",
)
def tb_merge(spark, sf):
    target = snapshot(spark, open_orders(spark, sf))
    target.merge(
        order_changes(spark, sf), "o_orderkey",
        [when_matched_update("s.kind = 'update'"), when_matched_delete("s.kind = 'delete'"), when_not_matched_insert("s.kind = 'insert'")],
    )
    return target.read()


@query(
    "tb_merge_add",
    f"""with {OPEN}, {CHANGES}
    select t.o_orderkey, t.o_orderstatus, t.o_totalprice + coalesce(s.o_totalprice, 0) as o_totalprice from target t
    left join source s on t.o_orderkey = s.o_orderkey and t.o_orderstatus = s.o_orderstatus
    union all
    select s.o_orderkey, s.o_orderstatus, s.o_totalprice from source s where s.kind <> 'delete' and not exists (
        select 1 from target t where t.o_orderkey = s.o_orderkey and t.o_orderstatus = s.o_orderstatus)""",
)
def tb_merge_add(spark, sf):
    target = snapshot(spark, open_orders(spark, sf))
    target.merge(
        order_changes(spark, sf), ["o_orderkey", "o_orderstatus"],
        [when_matched_update(set={"o_totalprice": "t.o_totalprice + s.o_totalprice"}), when_not_matched_insert("s.kind <> 'delete'")],
    )
    return target.read()


@query(
    "tb_insert_only",
    f"""with {OPEN}, {CHANGES} select * from target union all
    select o_orderkey, o_orderstatus, o_totalprice from source where kind = 'update' and o_orderkey not in (select o_orderkey from target)""",
)
def tb_insert_only(spark, sf):
    """Only new rows are written; the old files stay as they are."""
    target = snapshot(spark, open_orders(spark, sf))
    target.merge(order_changes(spark, sf), "o_orderkey", [when_not_matched_insert("s.kind = 'update'")])
    return target.read()


@query(
    "tb_merge_keys",
    """with target as (select case when event_type <> 'error' then user_id end as user_id, event_type, count(*) as n, min(value) as low from events group by 1, 2),
    source as (select distinct on (user_id, event_type) user_id, event_type, n from (
        select case when event_type <> 'error' then user_id end as user_id, event_type, count(*) filter (value > 20) as n from events where value > 10 group by 1, 2))
    select cast(t.user_id as varchar) as user_text, t.event_type, case when s.event_type is not null then s.n else t.n end as n, case when s.event_type is null then t.low end as low
    from target t left join source s on t.user_id is not distinct from s.user_id and t.event_type = s.event_type""",
)
def tb_merge_keys(spark, sf):
    """Keys 'a, b', NULL equal to NULL; a column that the source lacks becomes NULL."""
    from millrace.operators.merge import column_map

    events = table(spark, sf, "events").withColumn("user_id", F.when(F.col("event_type") != "error", F.col("user_id")))
    target = snapshot(spark, events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low")))
    source = events.filter("value > 10").groupBy("user_id", "event_type").agg(F.count_if(F.col("value") > 20).alias("n"))
    values = column_map(target.read().columns, source.columns)
    target.merge(source, "user_id, event_type", [when_matched_update(set=values), when_not_matched_insert(values=values)], null_safe=True)
    return target.read().select(F.col("user_id").cast("string").alias("user_text"), "event_type", "n", "low")


@query(
    "tb_merge_evolve",
    f"""with {OPEN}, {CHANGES}
    select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey, coalesce(s.o_orderstatus, t.o_orderstatus) as o_orderstatus,
        coalesce(s.o_totalprice, t.o_totalprice) as o_totalprice, s.kind from target t full join source s on t.o_orderkey = s.o_orderkey""",
)
def tb_merge_evolve(spark, sf):
    """The source's extra column is added; rows it does not mention have NULL there."""
    target = snapshot(spark, open_orders(spark, sf))
    target.merge(order_changes(spark, sf), "o_orderkey", [when_matched_update(), when_not_matched_insert()], evolve=True)
    return target.read()


@query(
    "tb_generated",
    "select event_id, epoch_us(ts) as micros, cast(cast(ts as date) as varchar) as day, true as refused from events",
)
def tb_generated(spark, sf):
    """A date derived from microseconds on write; a supplied date that disagrees is refused."""
    rule = {"day": "cast(cast(timestamp_micros(micros) AS DATE) AS STRING)"}
    rows = table(spark, sf, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"))
    target = snapshot(spark, rows, generated=rule)
    try:
        target.append(rows.withColumn("day", F.lit("1970-01-01")))
        refused = False
    except Exception as error:
        refused = "generated column day" in str(error)
    return target.read().withColumn("refused", F.lit(refused))


@query("tb_check", "select o_orderkey, o_totalprice, true as refused from orders where o_totalprice > 100000")
def tb_check(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    target = snapshot(
        spark, orders.filter("o_totalprice > 100000"), constraints={"large": "o_totalprice > 100000", "has_key": "o_orderkey IS NOT NULL"}
    )
    try:
        target.append(orders)
        refused = False
    except ConstraintViolated:
        refused = True
    return target.read().withColumn("refused", F.lit(refused))


@query("tb_partitioned", "select o_orderkey, o_totalprice, year(o_orderdate)::integer as order_year from orders where year(o_orderdate) >= 1997")
def tb_partitioned(spark, sf):
    """Partitions are pruned on read, and dropped without touching the others."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year"))
    target = snapshot(spark, rows, partition_by=["order_year"], comment="orders by year")
    target.delete("order_year < 1996")
    return target.read().filter("order_year >= 1997")


@query(
    "tb_partition_overwrite",
    """select o_orderkey, o_totalprice, year(o_orderdate)::integer as order_year from orders where year(o_orderdate) <> 1996 or o_totalprice > 300000""",
)
def tb_partition_overwrite(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year"))
    target = snapshot(spark, rows, partition_by=["order_year"])
    target.overwrite_partitions(rows.filter("order_year = 1996 AND o_totalprice > 300000"))
    return target.read()


@query(
    "tb_history",
    """with a as (select count(*) as n from orders where o_totalprice < 250000), b as (select count(*) as n from orders),
    c as (select count(*) as n from orders where o_totalprice < 50000), d as (select count(*) as n from orders where o_totalprice < 100000)
    select 0 as version, 'CREATE OR REPLACE' as operation, a.n as rows_added, 0 as rows_removed, a.n as row_count from a
    union all select 1, 'APPEND', b.n, 0, a.n + b.n from a, b
    union all select 2, 'DELETE', a.n + b.n - 2 * c.n, a.n + b.n, a.n + b.n - 2 * c.n from a, b, c
    union all select 3, 'UPDATE', a.n + b.n - 2 * c.n, a.n + b.n - 2 * c.n, a.n + b.n - 2 * c.n from a, b, c, d""",
)
def tb_history(spark, sf):
    target = snapshot(spark, open_orders(spark, sf))
    target.append(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"))
    target.delete("o_totalprice < 50000")
    target.update("o_totalprice < 100000", {"o_orderstatus": "'X'"})
    return target.history().select(F.col("version").cast("int").alias("version"), "operation", "rows_added", "rows_removed", "row_count")


@query(
    "tb_time_travel",
    """select 'by version' as how, o_orderstatus, count(*) as n from orders where o_totalprice < 250000 group by 2
    union all select 'by time', o_orderstatus, count(*) from orders where o_totalprice < 250000 group by 2
    union all select 'now', o_orderstatus, count(*) from orders where o_totalprice < 250000 and o_orderstatus <> 'F' group by 2""",
)
def tb_time_travel(spark, sf):
    target = snapshot(spark, open_orders(spark, sf))
    created = target.history().first()["committed_at"]
    target.delete("o_orderstatus = 'F'")
    frames = {"by version": target.read(version=0), "by time": target.read(as_of=created), "now": target.read()}
    counted = [df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).withColumn("how", F.lit(how)) for how, df in frames.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("tb_restore", "select o_orderkey, o_orderstatus, o_totalprice, 2 as newest from orders")
def tb_restore(spark, sf):
    target = snapshot(spark, all_orders(spark, sf))
    target.delete()
    newest = target.restore(0)
    return target.read().withColumn("newest", F.lit(newest))


@query("tb_compact", "select l_orderkey, l_partkey, l_quantity, true as fewer from lineitem")
def tb_compact(spark, sf):
    """Many files to few, rows with near keys together, rows unchanged."""
    target = snapshot(spark, table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity").repartition(16))
    before = target.usage().first()["files"]
    target.compact(["l_partkey"], files=4)
    return target.read().withColumn("fewer", F.lit(target.usage().first()["files"] < before))


@query("tb_cluster_curve", "select o_orderkey, o_custkey, o_totalprice, true as fewer from orders")
def tb_cluster_curve(spark, sf):
    """Clustered by two keys alike: no row changes, and a range of the second key meets fewer files than sorted in turn."""
    target = snapshot(spark, table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))
    middle = (F.col("low_o_totalprice") <= 260000) & (F.col("high_o_totalprice") >= 240000)
    target.compact(["o_custkey", "o_totalprice"], files=16)
    in_turn = target.file_ranges(["o_totalprice"]).filter(middle).count()
    target.compact(["o_custkey", "o_totalprice"], files=16, together=True)
    alike = target.file_ranges(["o_totalprice"]).filter(middle).count()
    return target.read().withColumn("fewer", F.lit(alike < in_turn))


@query(
    "tb_merge_indexed",
    """with s as (select l_orderkey as o_orderkey, max(l_linestatus) as o_orderstatus, max(l_quantity) as most from lineitem where l_quantity >= 49 group by 1)
    select o.o_orderkey, coalesce(s.o_orderstatus, o.o_orderstatus) as o_orderstatus, o.o_totalprice, coalesce(s.most, 0) as most
    from orders o left join s on s.o_orderkey = o.o_orderkey""",
)
def tb_merge_indexed(spark, sf):
    """A merge into a table with an index over its key: files that hold no key of the source are neither read nor written."""
    target = snapshot(spark, table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(0.0).alias("most")), index_by=["o_orderkey"])
    target.compact(["o_orderkey"], files=8)
    large = table(spark, sf, "lineitem").filter("l_quantity >= 49").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    changes = large.agg(F.max("l_linestatus").alias("o_orderstatus"), F.max("l_quantity").alias("most"))
    target.merge(changes, "o_orderkey", [when_matched_update()])
    return target.read()


@query("tb_repartition", "select o_orderkey, o_orderstatus, o_totalprice, true as as_asked from orders")
def tb_repartition(spark, sf):
    target = snapshot(spark, all_orders(spark, sf))
    target.repartition(3)
    files = target.read().select("_metadata.file_path").distinct().count()
    return target.read().withColumn("as_asked", F.lit(files == 3))


@query(
    "tb_expire_dry_run",
    """select o_orderkey, o_orderstatus, o_totalprice, 'millrace_version=0' as first_dead, 2 as dead_parts from orders where o_totalprice < 100000 and o_orderstatus <> 'F'""",
)
def tb_expire_dry_run(spark, sf):
    """List what may go, remove it, and read the newest version as before."""
    target = snapshot(spark, open_orders(spark, sf))
    target.delete("o_orderstatus = 'F'")
    target.delete("o_totalprice >= 100000")
    listed = target.expire(keep_versions=1, retain=timedelta(0), force=True)
    summary = listed.agg(F.min(F.substring_index("part", "-", 1)), F.count(F.lit(1)).cast("int")).first()
    target.expire(keep_versions=1, retain=timedelta(0), dry_run=False, force=True)
    return target.read().withColumns({"first_dead": F.lit(summary[0]), "dead_parts": F.lit(summary[1])})


@query(
    "tb_clone",
    """select o_orderkey, o_orderstatus, o_totalprice, 'deep' as kind from orders where o_totalprice < 250000 and o_orderstatus <> 'F'
    union all select o_orderkey, o_orderstatus, o_totalprice, 'shallow' from orders where o_totalprice < 250000 and o_orderstatus <> 'O'
    union all select o_orderkey, o_orderstatus, o_totalprice, 'origin' from orders where o_totalprice < 250000""",
)
def tb_clone(spark, sf):
    """Changes to a clone leave its origin alone."""
    origin = snapshot(spark, open_orders(spark, sf))
    deep = origin.clone(scratch(spark, "clone"))
    shallow = origin.clone(scratch(spark, "clone"), deep=False)
    deep.delete("o_orderstatus = 'F'")
    shallow.delete("o_orderstatus = 'O'")
    frames = [t.read().withColumn("kind", F.lit(k)) for k, t in (("deep", deep), ("shallow", shallow), ("origin", origin))]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("tb_external_survives_drop", "select o_orderkey, o_orderstatus, o_totalprice, true as managed_gone from orders")
def tb_external_survives_drop(spark, sf):
    """Dropping a schema removes a managed table's files and leaves an external table's."""
    from millrace import storage

    schema, outside = own_schema(spark), scratch(spark, "external")
    rows = all_orders(spark, sf)
    rows.write.saveAsTable(f"{schema}.managed")
    rows.write.option("path", outside).saveAsTable(f"{schema}.external")
    location = spark.sql(f"DESCRIBE SCHEMA {schema}").filter("info_name = 'Location'").first()["info_value"]
    spark.sql(f"DROP TABLE {schema}.managed")
    spark.sql(f"DROP SCHEMA {schema} CASCADE")
    gone = not storage.exists(spark, f"{location}/managed")
    return spark.read.parquet(outside).withColumn("managed_gone", F.lit(gone))
