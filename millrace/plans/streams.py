"""Incremental ingestion, streaming and materialised tables, change feeds, declared datasets."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numbers import rounded_sum
from millrace.operators.quality import DROP, Expectation
from millrace.operators.snapshots import SnapshotTable
from millrace.plans.registry import query
from millrace.session import scratch
from millrace.streaming import aggregates as A
from millrace.streaming import datasets as D
from millrace.streaming.changes import ChangeTable
from millrace.streaming.ingest import FileFeed, infer_schema, ingest
from millrace.streaming.joins import enrich_stream, interval_join
from millrace.tables import table


def incoming(spark, df, file_type: str = "json") -> str:
    """The rows as files in a folder a stream can watch."""
    path = scratch(spark, "incoming")
    writer = df.write.option("header", True) if file_type == "csv" else df.write
    writer.format(file_type).save(path)
    return path


def stream_of(spark, df):
    """A table as a stream of Parquet files."""
    return spark.readStream.schema(df.schema).parquet(incoming(spark, df, "parquet"))


def run(spark, stream):
    """Process all input there is, and read the result."""
    path = scratch(spark, "stream")
    D.append_stream(stream, path, scratch(spark, "checkpoint"))
    return spark.read.schema(stream.schema).parquet(path)


FEED_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType())
])

# ---- ingestion ----------------------------------------------------------------------------------


def feed(spark, sf):
    """Order records as JSON lines: some with an extra key, some with a price that is no number."""
    note = F.when(F.col("o_orderstatus") == "P", F.lit("call first")).alias("note")
    good = F.to_json(F.struct("o_orderkey", "o_orderstatus", "o_totalprice", note))
    bad = F.to_json(F.struct("o_orderkey", "o_orderstatus", F.lit("unknown").alias("o_totalprice"), note))
    path = scratch(spark, "incoming")
    table(spark, sf, "orders").select(F.when(F.col("o_orderpriority") == "1-URGENT", bad).otherwise(good).alias("value")).write.text(path)
    return path


RESCUED = """select o_orderkey, o_orderstatus, case when o_orderpriority <> '1-URGENT' then o_totalprice end as o_totalprice,
    case when o_orderpriority = '1-URGENT' then 'unknown' end as bad_price, case when o_orderstatus = 'P' then 'call first' end as extra, true as has_source from orders"""


def rescued(df):
    return df.select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.get_json_object("_rescued_data", "$.o_totalprice").alias("bad_price"),
        F.get_json_object("_rescued_data", "$.note").alias("extra"), (F.col("source_file").isNotNull() & F.col("processing_time").isNotNull()).alias("has_source"),
    )


@query("st_ingest", RESCUED)
def st_ingest(spark, sf):
    """Values that do not fit the schema are rescued, in the stream."""
    return run(spark, rescued(ingest(spark, feed(spark, sf), FEED_SCHEMA)))


@query("st_ingest_batch", RESCUED)
def st_ingest_batch(spark, sf):
    return rescued(ingest(spark, feed(spark, sf), FEED_SCHEMA, stream=False))


@query("st_ingest_inferred", "select o_orderkey, o_orderstatus, cast(o_totalprice as varchar) is not null as priced, cast(o_orderkey as varchar) as as_text from orders")
def st_ingest_inferred(spark, sf):
    """Types inferred, with a hint for one column; and all strings without inference."""
    path = incoming(spark, table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"))
    typed = infer_schema(spark, path, infer_types=True, hints={"o_totalprice": "decimal(12,2)"})
    texts = infer_schema(spark, path)
    rows = run(spark, ingest(spark, path, typed).select("o_orderkey", "o_orderstatus", F.col("o_totalprice").isNotNull().alias("priced")))
    strings = run(spark, ingest(spark, path, texts).select(F.col("o_orderkey").alias("as_text")))
    return rows.join(strings, F.col("o_orderkey").cast("string") == F.col("as_text"))


@query("st_ingest_csv", "select c_custkey, c_name, c_acctbal, true as has_source from customer")
def st_ingest_csv(spark, sf):
    """Files with their columns in different orders, each read by its own header."""
    customer, source = table(spark, sf, "customer"), scratch(spark, "incoming")
    for condition, columns in (("c_custkey % 2 = 0", ["c_custkey", "c_name", "c_acctbal"]), ("c_custkey % 2 = 1", ["c_acctbal", "c_custkey", "c_name"])):
        customer.filter(condition).select(*columns).write.mode("append").option("header", True).csv(source)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()), T.StructField("c_acctbal", T.DoubleType())])
    target = SnapshotTable(spark, scratch(spark, "snapshot"))
    FileFeed(spark, source, scratch(spark, "schemas"), "csv", schema).load_into(target, scratch(spark, "checkpoint"))
    fits = F.col("source_file").isNotNull() & F.col("_rescued_data").isNull()
    return target.read().select("c_custkey", "c_name", "c_acctbal", fits.alias("has_source"))


@query(
    "st_ingest_nested",
    """select o_orderkey, c_name as buyer, case when o_orderpriority <> '1-URGENT' then o_totalprice end as price,
    case when o_orderpriority = '1-URGENT' then 'unknown' end as bad_price, case when o_orderstatus = 'P' then 'call first' end as note, c_mktsegment as segment
    from orders join customer on o_custkey = c_custkey""",
)
def st_ingest_nested(spark, sf):
    """Nested records: a field of another type and one that the schema lacks are rescued under their dotted paths."""
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    orders = table(spark, sf, "orders").join(customer, "o_custkey")
    urgent, note = F.col("o_orderpriority") == "1-URGENT", F.when(F.col("o_orderstatus") == "P", F.lit("call first")).alias("note")
    buyer = F.struct(F.col("c_name").alias("name"), F.array(F.struct(F.col("c_mktsegment").alias("segment"))).alias("tags")).alias("buyer")
    good = F.to_json(F.struct("o_orderkey", buyer, F.struct(F.col("o_totalprice").alias("price"), note).alias("deal")))
    bad = F.to_json(F.struct("o_orderkey", buyer, F.struct(F.lit("unknown").alias("price"), note).alias("deal")))
    path = scratch(spark, "incoming")
    orders.select(F.when(urgent, bad).otherwise(good).alias("value")).write.text(path)
    schema = T.StructType.fromDDL("o_orderkey bigint, buyer struct<name: string, tags: array<struct<kind: string>>>, deal struct<price: double>")
    rescued = F.from_json("_rescued_data", "map<string,string>")
    return run(spark, ingest(spark, path, schema).select(
        "o_orderkey", F.col("buyer.name").alias("buyer"), F.col("deal.price").alias("price"), rescued["deal.price"].alias("bad_price"),
        rescued["deal.note"].alias("note"), rescued["buyer.tags[0].segment"].alias("segment"),
    ))


@query(
    "st_ingest_grows",
    """select o_orderkey, o_orderstatus, case when o_orderstatus = 'P' then o_orderpriority end as o_orderpriority,
    case when o_orderstatus = 'P' then o_totalprice end as price, 2 as n_schemas from orders""",
)
def st_ingest_grows(spark, sf):
    """Files with new fields, one of them nested, widen the schema and the table; older rows have nulls there."""
    orders, source = table(spark, sf, "orders"), scratch(spark, "incoming")
    key = F.struct("o_orderkey").alias("of")
    feed = FileFeed(spark, source, scratch(spark, "schemas"))
    target, checkpoint = SnapshotTable(spark, scratch(spark, "snapshot")), scratch(spark, "checkpoint")
    orders.filter("o_orderstatus <> 'P'").select(key, "o_orderstatus").write.json(source)
    feed.load_into(target, checkpoint)
    orders.filter("o_orderstatus = 'P'").select(F.struct("o_orderkey", F.col("o_totalprice").alias("price")).alias("of"), "o_orderstatus", "o_orderpriority").write.mode("append").json(source)
    feed.load_into(target, checkpoint)
    rows = target.read().filter("_rescued_data IS NULL")
    return rows.select("of.o_orderkey", "o_orderstatus", "o_orderpriority", "of.price", F.lit(len(feed.schemas())).alias("n_schemas"))


# ---- streaming and materialised tables ----------------------------------------------------------


@query("st_append", "select event_type, count(*) as n from events group by 1")
def st_append(spark, sf):
    """Input is read once, however often the stream is run; later files are added."""
    events = table(spark, sf, "events")
    source, target, checkpoint = scratch(spark, "incoming"), scratch(spark, "stream"), scratch(spark, "checkpoint")
    events.filter("event_type <> 'click'").write.parquet(source)
    for _ in range(2):
        D.append_stream(spark.readStream.schema(events.schema).parquet(source), target, checkpoint)
    events.filter("event_type = 'click'").write.mode("append").parquet(source)
    D.append_stream(spark.readStream.schema(events.schema).parquet(source), target, checkpoint)
    return spark.read.schema(events.schema).parquet(target).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("st_materialised", "select user_id, max(value) as top from events group by 1")
def st_materialised(spark, sf):
    """Recomputed on each refresh, so it equals its query on the newest input."""
    sets = D.Datasets(spark, scratch(spark, "sets"))
    events, limit = table(spark, sf, "events"), {"low": True}

    @sets.dataset(D.TABLE)
    def top_values(s):
        rows = events.filter("event_type = 'click'") if limit["low"] else events
        return rows.groupBy("user_id").agg(F.max("value").alias("top"))

    sets.run()
    limit["low"] = False
    sets.run()
    return sets.read("top_values")


@query("st_view", "select event_id, value from events where value > 20 and event_type = 'view'")
def st_view(spark, sf):
    """A view is not stored; it is read through the datasets that use it."""
    sets = D.Datasets(spark, scratch(spark, "sets"))

    @sets.dataset(D.VIEW)
    def views_only(s):
        return table(spark, sf, "events").filter("event_type = 'view'")

    @sets.dataset(D.TABLE)
    def large_views(s):
        return s.read("views_only").filter("value > 20").select("event_id", "value")

    sets.run()
    return sets.read("large_views")


@query("st_params", "select event_id, value from events where event_type = 'purchase' and value > 30")
def st_params(spark, sf):
    """What differs between runs comes in as parameters."""
    sets = D.Datasets(spark, scratch(spark, "sets"), {"source": f"{sf}/events.parquet", "kind": "purchase", "least": "30"})

    @sets.dataset(D.TABLE)
    def chosen(s):
        events = spark.read.parquet(s.parameters["source"])
        return spark.sql(
            "SELECT event_id, value FROM {events} WHERE event_type = :kind AND value > CAST(:least AS DOUBLE)",
            args={k: s.parameters[k] for k in ("kind", "least")}, events=events,
        )

    sets.run()
    return sets.read("chosen")


@query(
    "st_graph",
    """select c_mktsegment, count(*) as orders from orders join customer on o_custkey = c_custkey where o_totalprice > 100000 group by 1""",
)
def st_graph(spark, sf):
    """Declared in any order: a streaming table with a rule, a view over two datasets, a table over the view."""
    sets = D.Datasets(spark, scratch(spark, "sets"))
    customer, source = table(spark, sf, "customer"), stream_of(spark, table(spark, sf, "orders"))

    @sets.dataset(D.TABLE, comment="orders per segment", properties={"quality": "gold"})
    def per_segment(s):
        return s.read("placed").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("orders"))

    @sets.dataset(D.VIEW)
    def placed(s):
        return s.read("good_orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))

    @sets.dataset(D.STREAM, expectations=[Expectation("large", "o_totalprice > 100000", DROP)], properties={"quality": "silver"})
    def good_orders(s):
        return source

    sets.run()
    return sets.read("per_segment")


@query("st_continuous", "select event_type, count(*) as n from events group by 1")
def st_continuous(spark, sf):
    """A query that keeps running takes in files that come while it runs, until it is stopped."""
    events = table(spark, sf, "events")
    source, target, checkpoint = scratch(spark, "incoming"), scratch(spark, "stream"), scratch(spark, "checkpoint")
    events.filter("event_type <> 'click'").write.parquet(source)
    running = D.append_stream(spark.readStream.schema(events.schema).parquet(source), target, checkpoint, continuous_every="200 milliseconds")
    try:
        running.processAllAvailable()
        events.filter("event_type = 'click'").write.mode("append").parquet(source)
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema(events.schema).parquet(target).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


EVENT_STATS = {"n": A.Aggregate(A.COUNT), "top": A.Aggregate(A.MAX, "value"), "low_user": A.Aggregate(A.MIN, "user_id")}


@query("st_agg", "select event_type, count(*) as n, max(value) as top, min(user_id) as low_user from events group by 1")
def st_agg(spark, sf):
    """A running aggregate: two runs over growing input give the aggregate over all of it."""
    events = table(spark, sf, "events")
    source, checkpoint = scratch(spark, "incoming"), scratch(spark, "checkpoint")
    target = A.AggregateTable(spark, scratch(spark, "aggregate"), ["event_type"], EVENT_STATS)
    events.filter("value <= 10").write.parquet(source)
    target.apply_stream(spark.readStream.schema(events.schema).parquet(source), checkpoint)
    events.filter("value > 10").write.mode("append").parquet(source)
    target.apply_stream(spark.readStream.schema(events.schema).parquet(source), checkpoint)
    return target.current()


@query(
    "st_agg_users",
    """select user_id, count(*) as n, count(props) as with_props, round(sum(value), 4) as total, round(avg(value), 4) as mean, min(ts) as first_at, max(event_id) as last_id
    from events group by 1""",
)
def st_agg_users(spark, sf):
    """States of many groups, added week by week and folded where runs of like size have come together."""
    events = table(spark, sf, "events")
    stats = {
        "n": A.Aggregate(A.COUNT), "with_props": A.Aggregate(A.COUNT, "props"), "total": A.Aggregate(A.SUM, "value"),
        "mean": A.Aggregate(A.AVG, "value"), "first_at": A.Aggregate(A.MIN, "ts"), "last_id": A.Aggregate(A.MAX, "event_id"),
    }
    target = A.AggregateTable(spark, scratch(spark, "aggregate"), ["user_id"], stats, fan=2)
    for week in range(5):
        target.apply(events.filter(F.floor((F.dayofmonth("ts") - 1) / 7) == week), f"weeks:{week}")
    return target.current().withColumns({"total": F.round("total", 4), "mean": F.round("mean", 4)})


ORDER_STATS = {"n": A.Aggregate(A.COUNT), "worth": A.Aggregate(A.SUM, "o_totalprice"), "least": A.Aggregate(A.MIN, "o_totalprice"), "most": A.Aggregate(A.MAX, "o_totalprice")}


@query(
    "st_incremental",
    """with now as (select o_custkey, case when o_orderpriority = '2-HIGH' then o_totalprice * 2 else o_totalprice end as o_totalprice from orders
    where o_orderstatus <> 'F' or o_totalprice < 200000)
    select o_custkey, count(*) as n, round(sum(o_totalprice), 2) as worth, min(o_totalprice) as least, max(o_totalprice) as most from now group by 1""",
)
def st_incremental(spark, sf):
    """An aggregate that follows its source through an append, an update and a delete by their differences."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    source = SnapshotTable(spark, scratch(spark, "snapshot"))
    source.create(orders.filter("o_orderstatus <> 'P'"))
    kept_up = A.MaintainedAggregate(source, scratch(spark, "maintained"), ["o_custkey"], ORDER_STATS)
    changes = [
        lambda: source.append(orders.filter("o_orderstatus = 'P'")),
        lambda: source.update("o_orderpriority = '2-HIGH'", {"o_totalprice": "o_totalprice * 2"}),
        lambda: source.delete("o_orderstatus = 'F' AND o_totalprice >= IF(o_orderpriority = '2-HIGH', 400000, 200000)"),
    ]
    kept_up.refresh()
    for change in changes:
        change()
        kept_up.refresh()
    return kept_up.read().withColumn("worth", F.round("worth", 2))


@query(
    "a_sketch_days",
    """select cast(date_trunc('month', o_orderdate) as date)::varchar as month, count(distinct o_custkey) as buyers, true as close from orders group by 1""",
)
def a_sketch_days(spark, sf):
    """Distinct buyers of each month from sketches kept by day, within three hundredths of the exact count."""
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").cast("string").alias("day"), "o_custkey")
    days = A.AggregateTable(spark, scratch(spark, "aggregate"), ["day"], {"buyers": A.Aggregate(A.DISTINCT, "o_custkey")})
    for year in ("< '1998'", ">= '1998'"):
        days.apply(orders.filter(f"day {year}"))
    month = F.concat(F.substring("day", 1, 7), F.lit("-01")).alias("month")
    estimates = days.by(month).withColumnRenamed("buyers", "estimate")
    exact = orders.groupBy(month).agg(F.count_distinct("o_custkey").alias("buyers"))
    return exact.join(estimates, "month").select("month", "buyers", (F.abs(F.col("estimate") - F.col("buyers")) <= F.col("buyers") * 0.03).alias("close"))


# ---- stream joins -------------------------------------------------------------------------------


@query(
    "st_static_join",
    """select o_orderkey, c_name, c_mktsegment from orders left join (select c_custkey, c_name, c_mktsegment, c_nationkey from customer where c_acctbal > 0) on o_custkey = c_custkey
    and o_orderstatus <> 'P'""",
)
def st_static_join(spark, sf):
    """A stream of orders, left-joined to a table on two keys."""
    customer = table(spark, sf, "customer").filter("c_acctbal > 0").select("c_custkey", "c_name", "c_mktsegment", F.lit(True).alias("confirmed"))
    orders = stream_of(spark, table(spark, sf, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderstatus") != "P").alias("is_confirmed")))
    on = (F.col("o_custkey") == F.col("c_custkey")) & (F.col("is_confirmed") == F.col("confirmed"))
    return run(spark, orders.join(customer, on, "left").select("o_orderkey", "c_name", "c_mktsegment"))


@query("st_stream_join", "select event_id, c_name, value from events join customer on user_id = c_custkey")
def st_stream_join(spark, sf):
    """Two streams; customers, the smaller side, are held four times so that a busy user's events spread over four tasks."""
    events = stream_of(spark, table(spark, sf, "events").select("event_id", F.col("user_id").alias("id"), "value"))
    customers = stream_of(spark, table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_name"))
    return run(spark, enrich_stream(events, customers, ["id"], salts=4).select("event_id", "c_name", "value"))


MARK = -1  # not null: rows without a key are left out before the watermark sees them


def in_slices(spark, df, time, slices, columns):
    """A stream whose files come in the order of time, one for each micro-batch, and end with two rows of far times.

    The first lifts the watermark over all other rows, the second is the batch that sees it.
    """
    path = scratch(spark, "incoming")
    limits = df.agg(F.min(time).alias("low"), F.max(time).alias("high")).first()
    step = (limits.high - limits.low) / slices
    for i in range(slices):
        upper = limits.low + step * (i + 1)
        part = df.filter(F.col(time) >= limits.low + step * i) if i else df
        part = part.filter(F.col(time) < upper) if i < slices - 1 else part
        part.coalesce(1).write.mode("append").parquet(path)
    for steps in (10, 11):
        last = [limits.high + step * steps if c == time else MARK for c in columns]
        spark.createDataFrame([last], df.select(*columns).schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def clicks_and_buys(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("at"), "event_type")
    clicks = events.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("click"), F.col("at").alias("clicked"))
    buys = events.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("buy"), F.col("at").alias("bought"))
    return in_slices(spark, clicks, "clicked", 4, clicks.columns), in_slices(spark, buys, "bought", 4, buys.columns)


NEAR = "c.user_id = b.user_id and b.ts >= c.ts - interval 1 hour and b.ts <= c.ts + interval 1 day"
PAIRED = f"select c.user_id, c.event_id as click, b.event_id as buy from (select * from events where event_type = 'click') c {{}} join (select * from events where event_type = 'purchase') b on {NEAR}"


@query("st_stream_interval_join", PAIRED.format(""))
def st_stream_interval_join(spark, sf):
    """Two streams joined by user where a purchase lies near a click in time; what has passed leaves the state."""
    clicks, buys = clicks_and_buys(spark, sf)
    near = interval_join(clicks, buys, ["user_id"], "clicked", "bought", "1 hour", "1 day", "1 hour", "1 hour", long_batches=True)
    return run(spark, near.select("user_id", "click", "buy")).filter(F.col("user_id") != MARK)


@query("st_stream_interval_left", PAIRED.format("left"))
def st_stream_interval_left(spark, sf):
    """The same with clicks that no purchase followed, put out when none can come any more."""
    clicks, buys = clicks_and_buys(spark, sf)
    near = interval_join(clicks, buys, ["user_id"], "clicked", "bought", "1 hour", "1 day", "1 hour", "1 hour", how="left", long_batches=True)
    return run(spark, near.select("user_id", "click", "buy")).filter(F.col("user_id") != MARK)


@query(
    "st_gold_city",
    """select n_name as city, cast(cast(o_orderdate as date) as varchar) as day, round(sum(l_extendedprice), 2) as worth,
    sum(l_quantity) as pieces, count(l_partkey) as n_lines
    from orders join lineitem on o_orderkey = l_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    where n_name in ('NATION_3', 'NATION_7') group by 1, 2""",
)
def st_gold_city(spark, sf):
    """Nested orders of chosen cities, exploded and summed by day."""
    return gold_by_city(placed_sales(spark, sf), ["NATION_3", "NATION_7"])


def placed_sales(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    customer = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "city")
    orders = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    line = F.struct("l_partkey", "l_quantity", "l_extendedprice")
    return orders.join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(
        "city", F.to_date("o_orderdate").cast("string").alias("day"), F.array(line).alias("bought")
    )


def gold_by_city(orders, cities):
    each = orders.filter(F.col("city").isin(cities)).select("city", "day", F.inline("bought"))
    return each.groupBy("city", "day").agg(rounded_sum("l_extendedprice").alias("worth"), F.sum("l_quantity").alias("pieces"), F.count("l_partkey").alias("n_lines"))


# ---- change feeds -------------------------------------------------------------------------------


def event_changes(spark, sf):
    return table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")


def user_state(spark, **options):
    return ChangeTable(
        spark, scratch(spark, "changes"), ["user_id"], F.struct("ts", "event_id"), delete_when="event_type = 'error'", except_columns=["ts"], **options
    )


LATEST = """select user_id, event_id, event_type, value from (
    select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1 and event_type <> 'error'"""


@query("st_scd1", LATEST)
def st_scd1(spark, sf):
    """Latest event per user wins, an error deletes the user, as a stream."""
    target = user_state(spark)
    target.apply_stream(stream_of(spark, event_changes(spark, sf)), scratch(spark, "checkpoint"))
    return target.current()


@query("st_scd1_late", LATEST)
def st_scd1_late(spark, sf):
    """The same state when the newest changes come first and one batch comes twice, folded on the way."""
    target = user_state(spark, compact_every=2)
    changes = event_changes(spark, sf)
    for condition in ("value > 20", "value > 10 AND value <= 20", "value > 20", "value <= 10"):
        target.apply(changes.filter(condition))
    return target.current()

