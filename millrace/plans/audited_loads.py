"""Audited loads with schema versions, watermarks, roll-back and export logs."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from millrace.operators.cleaning import latest_per_key
from millrace.operators.loads import LoadArea, compare_schemas, export_audit, export_errors, high_watermark
from millrace.operators.quality import split_valid
from millrace.plans.registry import query
from millrace.session import scratch
from millrace.tables import table


def day(n: int) -> datetime:
    return datetime(2024, 1, n, tzinfo=timezone.utc)


def area(spark) -> LoadArea:
    return LoadArea(spark, scratch(spark, "loads"))


def balances(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")


@query(
    "ld_schema_diff",
    """select c_custkey, true as same_valid, false as wider_valid, true as narrower_valid, 'c_mktsegment,c_nationkey' as wider_new,
    'c_acctbal' as narrower_dropped, false as retyped_valid from customer""",
)
def ld_schema_diff(spark, sf):
    """An extract is valid if it brings no new column; types count only on request."""
    held, wide = balances(spark, sf), table(spark, sf, "customer")
    same, wider, narrower = compare_schemas(held, held), compare_schemas(held, wide), compare_schemas(held, held.drop("c_acctbal"))
    retyped = compare_schemas(held, held.withColumn("c_acctbal", F.col("c_acctbal").cast("string")), check_types=True)
    return held.select("c_custkey").withColumns({
        "same_valid": F.lit(same.valid), "wider_valid": F.lit(wider.valid), "narrower_valid": F.lit(narrower.valid),
        "wider_new": F.lit(",".join(sorted(wider.new))), "narrower_dropped": F.lit(",".join(narrower.dropped)), "retyped_valid": F.lit(retyped.valid),
    })


@query(
    "ld_write_modes",
    """select c_custkey, c_name, case when c_acctbal > 5000 then null else c_acctbal end as c_acctbal from customer where c_acctbal > 0
    union all select s_suppkey + 1000000000, s_name, s_acctbal from supplier""",
)
def ld_write_modes(spark, sf):
    """Overwrite, append, then merge an extract without the balance, which becomes NULL where it matches."""
    loads = area(spark)
    rows = balances(spark, sf).filter("c_acctbal > 0")
    suppliers = table(spark, sf, "supplier").select((F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal"))
    loads.write(rows, "accounts", "overwrite", "full", day(1))
    loads.write(suppliers, "accounts", "append", "delta", day(2), "c_custkey")
    loads.write(rows.filter("c_acctbal > 5000").drop("c_acctbal"), "accounts", "merge", "delta", day(3), "c_custkey, c_name")
    return loads.table("accounts").read()


@query(
    "ld_schema_bump",
    """select c_custkey, c_name, c_acctbal, case when c_mktsegment = 'BUILDING' then c_mktsegment end as c_mktsegment, 'v_002' as schema_version from customer
    where c_acctbal > 0 or c_mktsegment = 'BUILDING'""",
)
def ld_schema_bump(spark, sf):
    """A new column sends an append to the next schema version, merged with the old rows by key."""
    loads = area(spark)
    loads.write(balances(spark, sf).filter("c_acctbal > 0"), "accounts", "overwrite", "full", day(1))
    extract = table(spark, sf, "customer").drop("c_nationkey").filter("c_mktsegment = 'BUILDING'")
    version = loads.write(extract, "accounts", "append", "delta", day(2), "c_custkey")
    return loads.table("accounts").read().withColumn("schema_version", F.lit(version))


def three_loads(spark, sf):
    loads = area(spark)
    rows = balances(spark, sf)
    loads.write(rows, "accounts", "overwrite", "full", day(1))
    loads.write(rows.filter("c_acctbal > 0"), "accounts", "overwrite", "delta", day(3))
    loads.write(table(spark, sf, "supplier"), "suppliers", "overwrite", "full", day(2))
    return loads


@query(
    "ld_audit_append",
    """select 'accounts' as table_name, 'overwrite' as write_mode, 'full' as load_type, 'v_001' as schema_version, 0 as latest_version, 'none' as base_version,
    (select count(*) from customer) as rows_now
    union all select 'accounts', 'overwrite', 'delta', 'v_001', 1, '0', (select count(*) from customer where c_acctbal > 0)
    union all select 'suppliers', 'overwrite', 'full', 'v_001', 0, 'none', (select count(*) from supplier)""",
)
def ld_audit_append(spark, sf):
    """One audit row per load, next to the rows each load left."""
    loads = three_loads(spark, sf)
    histories = [loads.table(n).history().select(F.lit(n).alias("table_name"), F.col("version").alias("latest_version"), F.col("row_count").alias("rows_now")) for n in ("accounts", "suppliers")]
    rows = loads.audit_rows().select("table_name", "write_mode", "load_type", "schema_version", "latest_version", F.coalesce(F.col("base_version").cast("string"), F.lit("none")).alias("base_version"))
    joined = rows.join(histories[0].unionByName(histories[1]), ["table_name", "latest_version"])
    return joined.withColumn("latest_version", F.col("latest_version").cast("int"))


@query(
    "ld_latest_audit",
    """select 'accounts' as table_name, 'delta' as load_type, timestamp '2024-01-03' as load_date, (select count(*) from customer where c_acctbal > 0) as n
    union all select 'suppliers', 'full', timestamp '2024-01-02', (select count(*) from supplier)""",
)
def ld_latest_audit(spark, sf):
    loads = three_loads(spark, sf)
    counts = [loads.table(n).read().agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(n)) for n in ("accounts", "suppliers")]
    latest = loads.latest_loads(["accounts", "suppliers"]).select("table_name", "load_type", F.col("load_date").cast("timestamp_ntz").alias("load_date"))
    return latest.join(counts[0].unionByName(counts[1]), "table_name")


@query(
    "ld_latest_per_table",
    """select o_custkey, o_orderkey, o_orderdate, o_orderstatus from orders
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
)
def ld_latest_per_table(spark, sf):
    """The newest row of each group, all groups in one aggregation: orders as the log, customers as its tables."""
    log = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return latest_per_key(log, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("ld_high_watermark", "select date_trunc('second', max(ts)) as high_watermark from events where event_type <> 'error'")
def ld_high_watermark(spark, sf):
    texts = table(spark, sf, "events").select(F.when(F.col("event_type") == "error", "no time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("extracted"))
    return high_watermark(texts, "extracted").select(F.col("high_watermark").cast("timestamp_ntz").alias("high_watermark"))


@query(
    "ld_audit_delete",
    """select 'accounts' as table_name, 'delta' as load_type, count(*) as n from customer where c_acctbal > 0
    union all select 'suppliers', 'full', count(*) from supplier""",
)
def ld_audit_delete(spark, sf):
    loads = three_loads(spark, sf)
    loads.delete_audit_rows(loads.path("accounts", "v_001"), day(1))
    counts = [loads.table(n).read().agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(n)) for n in ("accounts", "suppliers")]
    return loads.audit_rows().select("table_name", "load_type").join(counts[0].unionByName(counts[1]), "table_name")


@query(
    "ld_export_audit",
    """select 'orders' as table_name, 'full' as export_type, count(*) filter (o_totalprice < 400000) as successful_transfers,
    count(*) filter (o_totalprice >= 400000) as failed_transfers, max(o_orderdate) as latest_date from orders""",
)
def ld_export_audit(spark, sf):
    audit = export_audit(table(spark, sf, "orders"), "o_totalprice < 400000", "orders", "export/orders", "run-1", "full", "o_orderdate")
    return audit.select("table_name", "export_type", "successful_transfers", "failed_transfers", "latest_date")


@query(
    "ld_export_errors",
    """select cast(o_orderkey as varchar) as row_id, 'price ' || o_orderstatus || ' over limit' as error_msg, o_orderpriority as priority from orders where o_totalprice >= 400000""",
)
def ld_export_errors(spark, sf):
    """Failed rows with their payload; the payload still holds the whole row."""
    _, failed = split_valid(table(spark, sf, "orders"), "o_totalprice < 400000")
    errors = export_errors(failed, "orders", "export/orders", "run-1", "o_orderkey", "concat('price ', o_orderstatus, ' over limit')", "full")
    return errors.select("row_id", "error_msg", F.get_json_object("payload", "$.o_orderpriority").alias("priority"))


@query(
    "ld_quality_gate",
    """select c_custkey, c_name, c_acctbal, -1 as before_loads, 0 as good, 1 as emptied from customer""",
)
def ld_quality_gate(spark, sf):
    """An emptied target is rolled back to its last version."""
    loads = area(spark)
    rows = balances(spark, sf)
    before = loads.quality_gate({"accounts": "full"}, "accounts", day(1))
    loads.write(rows, "accounts", "overwrite", "full", day(1))
    good = loads.quality_gate({"accounts": "full"}, "accounts", day(2))
    loads.write(rows.filter("c_custkey < 0"), "accounts", "overwrite", "full", day(3))
    emptied = loads.quality_gate({"accounts": "full"}, "accounts", day(4))
    return loads.table("accounts").read().withColumns({"before_loads": F.lit(before), "good": F.lit(good), "emptied": F.lit(emptied)})
