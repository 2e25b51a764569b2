"""Scans, sinks, catalog tables and the generic loader, as round trips of the given tables."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.snapshots import SnapshotTable
from millrace.plans.registry import query
from millrace.plans.relational import MEASURED, measured_lines
from millrace.session import scratch
from millrace.sources import catalog, timefolders
from millrace.sources.loader import load, parse_envelope, read_schema, retype
from millrace.tables import table

CUSTOMER_DDL = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def own_schema(spark):
    """A catalog schema of this call's own, with its files in the shared folder."""
    name = f"millrace_{uuid.uuid4().hex[:12]}"
    catalog.create_schema(spark, name, scratch(spark, name))
    return name


@query("src_file_query", "select * from orders")
def src_file_query(spark, sf):
    return spark.sql(f"SELECT * FROM parquet.`{sf}/orders.parquet`")


@query("src_text_lines", "select count(*) as lines, cast(count_if(contains(o_orderstatus, 'F')) as bigint) as finished from orders")
def src_text_lines(spark, sf):
    path = scratch(spark, "text")
    table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").write.json(path)
    lines = spark.read.text(path)
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("value").contains('"o_orderstatus":"F"')).alias("finished"))


@query("src_binary_stats", "select c_mktsegment as segment, 1::bigint as files, sum(length(c_name) + 1)::bigint as bytes, true as dated from customer group by 1")
def src_binary_stats(spark, sf):
    """Numbers and sizes of files, one per market segment; the content column is not read."""
    path = scratch(spark, "binary")
    names = table(spark, sf, "customer").select("c_name", "c_mktsegment").repartition("c_mktsegment").sortWithinPartitions("c_mktsegment")
    names.write.partitionBy("c_mktsegment").text(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    segment = F.regexp_extract("path", "/c_mktsegment=([^/]+)/", 1)
    return files.groupBy(segment.alias("segment")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.bool_and(F.col("modificationTime").isNotNull()).alias("dated")
    )


@query("src_csv_roundtrip", "select * from customer")
def src_csv_roundtrip(spark, sf):
    path = scratch(spark, "csv")
    table(spark, sf, "customer").write.option("header", True).option("sep", "\t").csv(path)
    df = spark.read.option("sep", "\t").option("header", True).option("inferSchema", True).csv(path)
    return df.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("src_csv_typed", "select * from orders")
def src_csv_typed(spark, sf):
    path = scratch(spark, "csv")
    df = table(spark, sf, "orders")
    df.write.option("header", True).csv(path)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return spark.read.option("header", True).schema(schema).csv(path)


@query("src_csv_ddl", "select * from part")
def src_csv_ddl(spark, sf):
    """The schema as DDL text, taken once from a frame and used again."""
    path = scratch(spark, "csv")
    df = table(spark, sf, "part")
    df.write.option("header", True).csv(path)
    return spark.read.schema(df.schema.toDDL()).csv(path, header=True)


@query("src_json_nested", f"select * from {MEASURED}")
def src_json_nested(spark, sf):
    path = scratch(spark, "json")
    documents = measured_lines(spark, sf)
    documents.write.json(path)
    return spark.read.schema(documents.schema).json(path).select("l_orderkey", "l_partkey", F.inline("measures"))


@query("src_json_inferred", f"select l_orderkey, count(*) as n, sum(amount) as total from {MEASURED} group by 1")
def src_json_inferred(spark, sf):
    path = scratch(spark, "json")
    measured_lines(spark, sf).write.json(path)
    each = spark.read.json(path).select("l_orderkey", F.explode("measures").alias("m"))
    return each.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("m.amount").alias("total"))


@query("snk_parquet_roundtrip", "select * from orders")
def snk_parquet_roundtrip(spark, sf):
    path = scratch(spark, "parquet")
    table(spark, sf, "orders").write.option("compression", "snappy").mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("snk_table_roundtrip", "select * from customer")
def snk_table_roundtrip(spark, sf):
    name = f"{own_schema(spark)}.customer"
    table(spark, sf, "customer").write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


@query("snk_snapshot_write", "select * from customer")
def snk_snapshot_write(spark, sf):
    target = SnapshotTable(spark, scratch(spark, "snapshot"))
    target.create(table(spark, sf, "customer"))
    return target.read()


@query("src_ext_csv_table", "select * from customer")
def src_ext_csv_table(spark, sf):
    path, name = scratch(spark, "csv"), f"{own_schema(spark)}.customer_csv"
    table(spark, sf, "customer").write.option("header", True).option("sep", "|").csv(path)
    catalog.external_table(spark, name, CUSTOMER_DDL, "csv", path, {"header": "true", "delimiter": "|"})
    return spark.table(name)


@query("src_ext_json_table", "select event_type as key, event_id as offset, epoch_us(ts) // 1000 as timestamp, props as value from events")
def src_ext_json_table(spark, sf):
    """Binary columns are base64 text in JSON and binary again when read."""
    path, name = scratch(spark, "json"), f"{own_schema(spark)}.events_raw"
    table(spark, sf, "events").select(
        F.col("event_type").cast("binary").alias("key"), F.col("event_id").alias("offset"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), F.col("props").cast("binary").alias("value"),
    ).write.json(path)
    catalog.external_table(spark, name, "key BINARY, offset BIGINT, timestamp BIGINT, value BINARY", "json", path)
    return spark.table(name).withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


@query("src_refresh_count", "select (select count(*) from supplier) as n_before, (select count(*) from supplier) + (select count(*) from customer) as n")
def src_refresh_count(spark, sf):
    """Files added behind a cached table show up after a refresh."""
    path, name = scratch(spark, "csv"), f"{own_schema(spark)}.accounts"
    table(spark, sf, "supplier").select("s_name", "s_acctbal").write.csv(path)
    catalog.external_table(spark, name, "name STRING, balance DOUBLE", "csv", path)
    held = spark.table(name)
    n_before = held.count()  # lists the files
    table(spark, sf, "customer").select("c_name", "c_acctbal").write.mode("append").csv(path)
    stale = held.count()  # still those files
    if stale != n_before:
        raise ValueError("the table was listed again before the refresh")
    spark.catalog.refreshTable(name)
    return spark.table(name).agg(F.lit(stale).cast("long").alias("n_before"), F.count(F.lit(1)).alias("n"))


@query("view_cte", "select n_name, count(*) as customers from customer join nation on c_nationkey = n_nationkey group by 1 having count(*) > 0")
def view_cte(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("millrace_customer")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW millrace_nation AS SELECT * FROM parquet.`{sf}/nation.parquet`")
    return spark.sql(
        """WITH homes AS (SELECT n_name FROM millrace_customer JOIN millrace_nation ON c_nationkey = n_nationkey)
           SELECT n_name, count(*) AS customers FROM homes GROUP BY n_name"""
    )


@query("src_failfast_view", "select c_custkey, c_name from customer where c_mktsegment = 'BUILDING'")
def src_failfast_view(spark, sf):
    path = scratch(spark, "csv")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    catalog.view_over_files(spark, "millrace_customer_csv", "csv", path, {"header": "true", "mode": "FAILFAST", "inferSchema": "true"})
    return spark.sql("SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name FROM millrace_customer_csv WHERE c_mktsegment = 'BUILDING'")


@query("src_provenance", "select event_type, count(*) as rows_read, 1 as folders, true as loaded from events group by 1")
def src_provenance(spark, sf):
    """Source file and load time of each row; counts per partition folder of the source."""
    path = scratch(spark, "parquet")
    table(spark, sf, "events").write.partitionBy("event_type").parquet(path)
    tagged = spark.read.parquet(path).select("event_type", F.col("_metadata.file_path").alias("source_file"), F.current_timestamp().alias("load_time"))
    folder = F.regexp_extract("source_file", "/(event_type=[^/]+)/", 1)
    return tagged.groupBy("event_type").agg(
        F.count("source_file").alias("rows_read"), F.count_distinct(folder).cast("int").alias("folders"), F.bool_and(F.col("load_time").isNotNull()).alias("loaded")
    )


@query(
    "gen_range",
    """with d as (select cast(o_orderdate as date) as day from orders)
    select day, count(d.day) as orders from (select cast(unnest(generate_series(min(day), max(day), interval 1 day)) as date) as day from d) left join d using (day) group by 1""",
)
def gen_range(spark, sf):
    """A generated range of days as the spine of a count that also shows days without rows."""
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    first, last = days.agg(F.min(F.unix_date("day")), F.max(F.unix_date("day"))).first()
    spine = spark.range(first or 0, (last if last is not None else -1) + 1).select(F.date_from_unix_date(F.col("id").cast("int")).alias("day"))
    counts = days.groupBy("day").agg(F.count(F.lit(1)).alias("orders"))
    return spine.join(counts, "day", "left").na.fill(0, ["orders"])


@query("gen_values", "select o_orderkey, case o_orderstatus when 'O' then 'open' when 'F' then 'finished' else 'pending' end as label from orders")
def gen_values(spark, sf):
    """Typed-in rows: as tuples and as VALUES. Three rows, so broadcasting them is safe."""
    open_ = spark.createDataFrame([("O", "open")], "code string, label string")
    others = spark.sql("SELECT * FROM VALUES ('F', 'finished'), ('P', 'pending') AS v(code, label)")
    labels = open_.union(others)
    return table(spark, sf, "orders").join(F.broadcast(labels), F.col("o_orderstatus") == F.col("code"), "left").select("o_orderkey", "label")


@query("ld_generic_csv", "select * from customer")
def ld_generic_csv(spark, sf):
    """The schema comes from a JSON file, as a load would keep it."""
    path, schema_path = scratch(spark, "csv"), scratch(spark, "schema")
    df = table(spark, sf, "customer")
    df.write.option("header", True).csv(path)
    spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.text(schema_path)
    return load(spark, path, "csv", read_schema(spark, f"{schema_path}/*.txt"))


@query("ld_generic_json_multiline", "select event_id, user_id, event_type from events")
def ld_generic_json_multiline(spark, sf):
    path = scratch(spark, "json")
    df = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    # Each file is one JSON array over many lines. Reading such a file takes one task, so its size is bounded.
    line = F.to_json(F.struct(*df.columns))
    blocks = df.select(line.alias("line"), F.floor(F.monotonically_increasing_id() / 100_000).alias("block")).groupBy("block").agg(F.collect_list("line").alias("lines"))
    text = F.concat(F.lit("[\n"), F.array_join("lines", ",\n"), F.lit("\n]"))
    blocks.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return load(spark, path, "json", df.schema, json_multiline=True)


@query("ld_generic_xml", "select c_custkey, c_name, c_acctbal from customer")
def ld_generic_xml(spark, sf):
    path = scratch(spark, "xml")
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    df.write.format("xml").option("rowTag", "customer").save(path)
    return load(spark, path, "xml", df.schema, options={"rowTag": "customer"})


@query("ld_envelope_json", "select cast(props->>'$.k' as bigint) as k from events")
def ld_envelope_json(spark, sf):
    return parse_envelope(table(spark, sf, "events").select(F.col("props").cast("binary").alias("Body")), "Body")


@query(
    "copy_retype",
    """select s_suppkey, s_name, case when s_acctbal < 0 then -1 else s_nationkey end as s_nationkey, s_acctbal from supplier""",
)
def copy_retype(spark, sf):
    """A supplier list kept as text, retyped on the way into a new table; a dash stands for an unknown nation."""
    listed = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string"), "s_name", F.when(F.col("s_acctbal") < 0, "-").otherwise(F.col("s_nationkey").cast("string")).alias("s_nationkey"),
        F.col("s_acctbal").cast("string"),
    )
    name = f"{own_schema(spark)}.suppliers"
    retype(listed, {"s_suppkey": "bigint", "s_nationkey": "int", "s_acctbal": "double"}, {"s_nationkey": ("-", -1)}).write.saveAsTable(name)
    return spark.table(name)


@query(
    "meta_columns",
    """select column_name, n as values from (select count(event_id) as event_id, count(ts) as ts, count(user_id) as user_id, count(event_type) as event_type,
    count(value) as value from (select event_id, ts, case when event_type <> 'error' then user_id end as user_id, event_type, value from events))
    unpivot (n for column_name in (event_id, ts, user_id, event_type, value))""",
)
def meta_columns(spark, sf):
    events = table(spark, sf, "events").withColumn("user_id", F.when(F.col("event_type") != "error", F.col("user_id"))).drop("props")
    return catalog.column_profile(events).select("column_name", "values")


@query("meta_details", "select 3::bigint as num_files, sum(length(c_name) + 1)::bigint as size_in_bytes from customer")
def meta_details(spark, sf):
    """Files and bytes of a table of text lines, of which both are known."""
    path = scratch(spark, "lines")
    table(spark, sf, "customer").select("c_name").repartition(3).write.text(path)
    return catalog.file_details(spark.read.text(path))


@query("meta_listing", "select 'orders' as table_name, count(*) as n from orders union all select 'customer', count(*) from customer")
def meta_listing(spark, sf):
    """Tables of a schema, with their row counts."""
    schema = own_schema(spark)
    for name in ("orders", "customer"):
        table(spark, sf, name).write.saveAsTable(f"{schema}.{name}")
    listed = spark.sql(f"SHOW TABLES IN {schema}").filter("NOT isTemporary").select(F.col("tableName").alias("table_name"))
    counts = [spark.table(f"{schema}.{n}").agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(n)) for n in ("orders", "customer")]
    return listed.join(counts[0].unionByName(counts[1]), "table_name")


@query("meta_describe", "select column_name as col_name from (describe select * from orders)")
def meta_describe(spark, sf):
    schema = own_schema(spark)
    table(spark, sf, "orders").write.saveAsTable(f"{schema}.orders")
    described = spark.sql(f"DESCRIBE {schema}.orders")
    return described.select("col_name")


def by_day_folders(spark, sf):
    """Events under year, month, day, hour and minute folders, one set of folders per day."""
    path = scratch(spark, "folders")
    ts = F.col("ts")
    df = table(spark, sf, "events").select(
        "event_id", "ts", F.year(ts).alias("y"), F.month(ts).alias("mo"), F.dayofmonth(ts).alias("d"), F.lit(0).alias("h"), F.lit(0).alias("mi")
    )
    # Rebalancing gathers each day in few files, and splits a day that is too large for one task.
    df.hint("rebalance", "y", "mo", "d").write.partitionBy("y", "mo", "d", "h", "mi").parquet(path)
    return path


@query("ld_latest_partition", "select date_trunc('day', max(ts)) as latest from events")
def ld_latest_partition(spark, sf):
    return timefolders.latest_folder_time(spark, by_day_folders(spark, sf))


@query("ld_time_range_read", "select event_id, ts from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-12'")
def ld_time_range_read(spark, sf):
    return timefolders.read_time_range(spark, by_day_folders(spark, sf), datetime(2024, 1, 5), datetime(2024, 1, 12))
