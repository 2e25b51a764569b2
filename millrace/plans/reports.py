"""Questions answered end to end by several operators together."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.numbers import rounded_avg, rounded_sum, net_price
from millrace.functions.text import EMAIL_PATTERN, email_domain
from millrace.operators import cleaning
from millrace.operators.hotkeys import join_hot_keys
from millrace.operators.pivot import pivot_listed
from millrace.operators.quality import DROP, FAIL, Expectation
from millrace.plans.registry import query
from millrace.plans.streams import incoming, stream_of
from millrace.session import scratch
from millrace.streaming import aggregates as A
from millrace.streaming import datasets as D
from millrace.streaming.changes import ChangeTable
from millrace.streaming.ingest import infer_schema, ingest
from millrace.tables import table

KINDS = ["click", "error", "purchase", "signup", "view"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "c_top_revenue",
    """select o_orderpriority, round(total, 2) as total_rev, round(total / n, 2) as avg_rev from (
        select o_orderpriority, round(sum(l_extendedprice * (1 - l_discount)), 2) as total, count(*) as n
        from orders join lineitem on o_orderkey = l_orderkey group by 1) order by total desc limit 3""",
)
def c_top_revenue(spark, sf):
    """The three order priorities with the most revenue, with total and mean per line."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", net_price().alias("rev")).filter(F.col("rev").isNotNull())
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    totals = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderpriority").agg(
        rounded_sum("rev").alias("total"), rounded_avg("rev").alias("mean")
    )
    top = totals.sort(F.col("total").desc()).limit(3)
    return top.select("o_orderpriority", F.round("total", 2).alias("total_rev"), F.round("mean", 2).alias("avg_rev"))


@query(
    "c_abandoned",
    """with converted as (select distinct o_custkey from orders where o_totalprice > 400000),
    carts as (select distinct o_custkey, l_partkey from orders join lineitem on o_orderkey = l_orderkey)
    select l_partkey as item, count(*) as count from customer join carts on c_custkey = o_custkey
    where c_custkey not in (select o_custkey from converted) group by 1""",
)
def c_abandoned(spark, sf):
    """Items in carts of customers who never converted, with the number of such customers.

    A cart is a set of (customer, item) pairs rather than an array per customer: the result is
    the same, and a customer with very many items needs no more room in a task than others.
    """
    orders = table(spark, sf, "orders")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    undecided = customers.join(orders.filter("o_totalprice > 400000"), "o_custkey", "left_anti")
    placed = join_hot_keys(orders.select("o_orderkey", "o_custkey"), undecided, ["o_custkey"])
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("item"))
    carts = placed.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", "item").distinct()
    return carts.groupBy("item").count().sort("item")


@query(
    "c_clickpath",
    """with p as (select user_id, count(*) filter (event_type = 'click') as click, count(*) filter (event_type = 'error') as error,
        count(*) filter (event_type = 'purchase') as purchase, count(*) filter (event_type = 'signup') as signup, count(*) filter (event_type = 'view') as view
        from events group by 1)
    select p.*, l_orderkey, l_partkey, l_quantity from p join orders on o_custkey = user_id join lineitem on l_orderkey = o_orderkey""",
)
def c_clickpath(spark, sf):
    """Counts of each kind of event per user, next to each item the user bought."""
    paths = pivot_listed(table(spark, sf, "events"), ["user_id"], "event_type", KINDS, F.count, F.lit(1))
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    bought = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return join_hot_keys(orders, paths, ["user_id"]).join(bought, F.col("o_orderkey") == F.col("l_orderkey")).drop("o_orderkey")


@query(
    "c_item_pivot",
    """select l_orderkey, sum(l_quantity) filter (p_type = 'ECONOMY') as economy, sum(l_quantity) filter (p_type = 'LARGE') as large,
    sum(l_quantity) filter (p_type = 'MEDIUM') as medium, sum(l_quantity) filter (p_type = 'PROMO') as promo,
    sum(l_quantity) filter (p_type = 'SMALL') as small, sum(l_quantity) filter (p_type = 'STANDARD') as standard
    from lineitem join part on l_partkey = p_partkey group by 1""",
)
def c_item_pivot(spark, sf):
    """Quantity per order and kind of part."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    typed = lines.join(table(spark, sf, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return pivot_listed(typed, ["l_orderkey"], "p_type", TYPES, F.sum, "l_quantity")


@query(
    "c_clean_users",
    """with dirty as (select case when event_type <> 'error' then user_id end as user_id, date_trunc('hour', ts) as first_touch,
        case when value > 10 then 'u' || user_id || '@' || event_type || '.example.com' end as email from events),
    clean as (select user_id, first_touch, max(email) as email from dirty where user_id is not null group by 1, 2)
    select user_id, first_touch, email, dayname(first_touch)[:3] as weekday, hour(first_touch)::integer as hour,
    split_part(email, '@', 2) as mail_host, (select count(*) from dirty where user_id is null) as without_user,
    (select count(*) from dirty where email is null) as without_mail, true as unique_rows from clean""",
)
def c_clean_users(spark, sf):
    """Count gaps, drop and collapse, check uniqueness, derive weekday, hour and mail host."""
    dirty = table(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("first_touch"),
        F.when(F.col("value") > 10, F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@"), "event_type", F.lit(".example.com"))).alias("email"),
    )
    clean = cleaning.collapse(dirty, ["user_id", "first_touch"], ["email"])
    derived = clean.withColumns({
        "weekday": F.date_format("first_touch", "EEE"), "hour": F.hour("first_touch"), "mail_host": email_domain("email"),
    })
    # Each check is one value.
    nulls = cleaning.null_counts(dirty, ["user_id", "email"])
    unique = cleaning.is_unique(clean, ["user_id", "first_touch"])
    return derived.select(
        "*", nulls.select("user_id_nulls").scalar().alias("without_user"), nulls.select("email_nulls").scalar().alias("without_mail"),
        unique.scalar().alias("unique_rows"),
    )


@query(
    "c_user_summary",
    """select user_id, min(ts) as first_seen, max(ts) as last_seen, count(*) as total_records, round(avg(value), 4) as mean_value
    from events group by 1""",
)
def c_user_summary(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("total_records"), rounded_avg("value").alias("mean_value")
    ).orderBy("user_id")


@query("c_medallion_orders", "select cast(date_trunc('month', o_orderdate) as date)::varchar as month, count(*) as placed, count(distinct o_custkey) as buyers from orders group by 1")
def c_medallion_orders(spark, sf):
    """Raw files to typed stream, to checked stream, to counts by month."""
    source = incoming(spark, table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate"))
    schema = infer_schema(spark, source, infer_types=True, hints={"o_orderdate": "timestamp_ntz"})
    sets = D.Datasets(spark, scratch(spark, "sets"), {"source": source})

    @sets.dataset(D.STREAM, properties={"kept_for": "30 days"})
    def landed(s):
        return ingest(spark, s.parameters["source"], schema)

    @sets.dataset(D.STREAM, expectations=[Expectation("keyed", "o_orderkey >= 0 AND o_custkey >= 0", FAIL)], comment="orders with their keys")
    def typed(s):
        return s.read_stream("landed").select("o_orderkey", "o_custkey", "o_orderdate")

    @sets.dataset(D.TABLE)
    def by_month(s):
        month = F.trunc("o_orderdate", "MM").cast("string").alias("month")
        return s.read("typed").groupBy(month).agg(F.count(F.lit(1)).alias("placed"), F.count_distinct("o_custkey").alias("buyers"))

    sets.run()
    return sets.read("by_month")


def users_now(spark, sf):
    """Latest state of each user from a feed of changes: removed by an error, and unreachable rows left out."""
    changes = table(spark, sf, "events").select(
        "user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.col("event_type").alias("last_action"),
        F.when(F.col("value") > 3, F.concat(F.lit("u"), F.col("event_id").cast("string"), F.lit("@example.com"))).otherwise(F.lit("none")).alias("mail"),
        (F.col("event_type") == "error").alias("removal"),
    )
    source = incoming(spark, changes)
    rules = [
        Expectation("ordered", "at > 0 AND event_id >= 0", FAIL),
        Expectation("not_a_signup", "last_action <> 'signup'", DROP),
        Expectation("reachable", F.col("removal") | F.col("mail").rlike(EMAIL_PATTERN), DROP),
    ]
    schema = changes.schema
    sets = D.Datasets(spark, scratch(spark, "sets"), {"source": source})

    @sets.dataset(D.STREAM)
    def feed(s):
        return ingest(spark, s.parameters["source"], schema)

    @sets.dataset(D.STREAM, expectations=rules)
    def usable(s):
        return s.read_stream("feed")

    sets.run()
    users = ChangeTable(
        spark, scratch(spark, "changes"), ["user_id"], F.struct("at", "event_id"), delete_when="removal",
        except_columns=["removal", "source_file", "processing_time", "_rescued_data"],
    )
    users.apply_stream(sets.read_stream("usable"), scratch(spark, "checkpoint"))
    return users.current()


USERS = """users as (select user_id, last_action, mail from (
    select user_id, event_type as last_action, 'u' || event_id || '@example.com' as mail, event_type = 'error' as gone,
        row_number() over (partition by user_id order by ts desc, event_id desc) as rn
    from events where event_type <> 'signup' and (value > 3 or event_type = 'error')) where rn = 1 and not gone)"""


@query("c_cdc_counts", f"with {USERS} select last_action, count(*) as n_users from users group by 1")
def c_cdc_counts(spark, sf):
    return users_now(spark, sf).groupBy("last_action").agg(F.count(F.lit(1)).alias("n_users"))


@query(
    "c_cdc",
    f"""with {USERS} select l_orderkey, l_linestatus, l_shipdate, mail from lineitem
    join orders on o_orderkey = l_orderkey join users on o_custkey = user_id where o_orderpriority in ('1-URGENT', '2-HIGH') and l_shipdate > timestamp '1996-01-01'""",
)
def c_cdc(spark, sf):
    """Shipments of urgent orders, with the current mail address of the user to tell."""
    users = users_now(spark, sf)
    urgent = table(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    wanted = urgent.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
    mails = join_hot_keys(wanted, users.select("user_id", "mail"), ["user_id"]).select("l_orderkey", "mail")
    shipped = table(spark, sf, "lineitem").filter("l_shipdate > TIMESTAMP_NTZ '1996-01-01'").select("l_orderkey", "l_linestatus", "l_shipdate")
    return shipped.join(mails, "l_orderkey")


@query(
    "c_daily_mean",
    """select user_id as patient, c_name as name, cast(cast(ts as date) as varchar) as day, round(avg(value), 4) as avg_rate
    from events join customer on user_id = c_custkey where value > 5 group by 1, 2, 3""",
)
def c_daily_mean(spark, sf):
    """A stream of recordings joined to the table of patients, bad values dropped, then the mean per patient and day."""
    recordings = stream_of(spark, table(spark, sf, "events").select(F.col("user_id").alias("patient"), "event_id", "ts", "value"))
    patients = table(spark, sf, "customer").select(F.col("c_custkey").alias("patient"), F.col("c_name").alias("name"))
    sets = D.Datasets(spark, scratch(spark, "sets"))

    @sets.dataset(D.STREAM, expectations=[Expectation("positive", "value > 5", DROP)])
    def rates(s):
        return recordings.join(patients, "patient")  # a static side keeps no state

    sets.run()
    rows = sets.read_stream("rates").withColumn("day", F.to_date("ts").cast("string"))
    daily = A.AggregateTable(spark, scratch(spark, "aggregate"), ["patient", "name", "day"], {"avg_rate": A.Aggregate(A.AVG, "value")})
    daily.apply_stream(rows, scratch(spark, "checkpoint"))
    return daily.current().withColumn("avg_rate", F.round("avg_rate", 4))
