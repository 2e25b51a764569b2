"""Projection, filters, joins, aggregation, windows, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.numbers import rounded_avg, rounded_sum, net_price
from millrace.functions.text import is_email
from millrace.operators import cleaning
from millrace.operators.hotkeys import join_hot_keys
from millrace.operators.nesting import unnest
from millrace.plans.registry import query
from millrace.tables import table

# ---- shared inputs ------------------------------------------------------------------------------


def customer_places(spark, sf):
    """Customers with a nested place: nation and region."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    joined = (
        table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select("c_custkey", "c_name", "c_acctbal", F.struct("n_name", "r_name").alias("geo"))


PLACES = """customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""


def measured_lines(spark, sf):
    """Order lines as documents, each with an array of its own measures."""
    measure = lambda kind, amount: F.struct(F.lit(kind).alias("kind"), amount.cast("double").alias("amount"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", F.array(measure("pieces", F.col("l_quantity")), measure("place", F.col("l_linenumber"))).alias("measures")
    )


MEASURED = """(select l_orderkey, l_partkey, 'pieces' as kind, l_quantity as amount from lineitem
    union all select l_orderkey, l_partkey, 'place', l_linenumber::double from lineitem)"""


def nulled_events(spark, sf):
    """Events with NULLs: error events have no user, and values under 5 are missing."""
    return table(spark, sf, "events").select(
        "event_id", "ts", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"), "event_type",
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
    )


NULLED = """(select event_id, ts, case when event_type <> 'error' then user_id end as user_id, event_type,
    case when value >= 5 then value end as value from events)"""


# ---- projection ---------------------------------------------------------------------------------


@query("p_select", "select p_name, p_retailprice from part")
def p_select(spark, sf):
    return table(spark, sf, "part").select("p_name", "p_retailprice")


@query("p_sql", "select p_partkey, p_name, p_retailprice from part where p_retailprice < 950")
def p_sql(spark, sf):
    return spark.sql(
        "SELECT p_partkey, p_name, p_retailprice FROM {part} WHERE p_retailprice < :top ORDER BY p_retailprice, p_partkey",
        args={"top": 950}, part=table(spark, sf, "part"),
    )


@query("p_nested_field", f"select c_custkey, n_name as nation, r_name as region from {PLACES}")
def p_nested_field(spark, sf):
    df = customer_places(spark, sf)
    return df.select(df.c_custkey, df["geo.n_name"].alias("nation"), F.col("geo.r_name").alias("region"))


@query("p_select_expr", "select o_orderkey, o_orderpriority in ('1-URGENT', '2-HIGH') as rush from orders")
def p_select_expr(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderpriority in ('1-URGENT', '2-HIGH') as rush")


@query("p_drop", "select p_partkey, p_brand, p_size from part")
def p_drop(spark, sf):
    df = table(spark, sf, "part")
    return df.drop("p_name", "p_type").drop(F.col("p_retailprice"))


@query("p_with_column", "select *, c_mktsegment in ('BUILDING', 'MACHINERY') as heavy, c_acctbal < 0 as in_debt from customer")
def p_with_column(spark, sf):
    return table(spark, sf, "customer").withColumns(
        {"heavy": F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "in_debt": F.col("c_acctbal") < 0}
    )


@query("p_rename", "select s_suppkey as id, s_name as supplier_name, s_nationkey, s_acctbal from supplier")
def p_rename(spark, sf):
    return table(spark, sf, "supplier").withColumnRenamed("s_name", "supplier_name").withColumnsRenamed({"s_suppkey": "id"})


@query("p_star_except", f"select c_custkey, c_acctbal, n_name, r_name from {PLACES}")
def p_star_except(spark, sf):
    return spark.sql("SELECT * EXCEPT (geo, c_name), geo.* FROM {places}", places=customer_places(spark, sf))


# ---- filters and value expressions --------------------------------------------------------------


@query("f_string", "select o_orderkey, o_totalprice from orders where o_totalprice > 400000 and o_orderstatus = 'F'")
def f_string(spark, sf):
    return table(spark, sf, "orders").where("o_totalprice > 400000").filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


@query(
    "f_compound",
    "select event_id, event_type from events where (event_type <> 'error' and value > 20) or not (user_id < 140)",
)
def f_compound(spark, sf):
    df = table(spark, sf, "events")
    return df.filter(((F.col("event_type") != "error") & (F.col("value") > 20)) | ~(F.col("user_id") < 140)).select("event_id", "event_type")


@query(
    "f_null",
    f"select event_id, user_id is null as no_user, value is null as no_value from {NULLED} where value is null or user_id is not null",
)
def f_null(spark, sf):
    df = nulled_events(spark, sf)
    return df.filter(F.col("value").isNull() | F.isnan("value") | F.col("user_id").isNotNull()).select(
        "event_id", F.isnull("user_id").alias("no_user"), F.col("value").isNull().alias("no_value")
    )


@query("f_isin", "select event_id, user_id from events where event_type in ('click', 'view')")
def f_isin(spark, sf):
    return table(spark, sf, "events").filter(F.col("event_type").isin("click", "view")).select("event_id", "user_id")


@query("f_endswith", "select c_custkey, c_name from customer where c_name like '%7'")
def f_endswith(spark, sf):
    return table(spark, sf, "customer").filter(F.col("c_name").endswith("7")).select("c_custkey", "c_name")


@query("f_like", "select p_partkey, p_name from part where p_name like 's%g' or p_type like 'PRO%'")
def f_like(spark, sf):
    return table(spark, sf, "part").filter(F.col("p_name").like("s%g") | F.col("p_type").like("PRO%")).select("p_partkey", "p_name")


@query(
    "f_rlike",
    r"""select doc_id, word from (select doc_id, unnest(regexp_split_to_array(text, '[\s,;:<>()"'']+')) as word from documents)
    where regexp_matches(word, '^([a-zA-Z0-9_\-\.]+)@([a-zA-Z0-9_\-\.]+)\.([a-zA-Z]{2,5})$')""",
)
def f_rlike(spark, sf):
    """Words of all texts that are e-mail addresses."""
    texts = table(spark, sf, "documents").filter(F.contains("text", F.lit("@")))
    likely = F.filter(F.split("text", r"""[\s,;:<>()"']+"""), lambda w: w.contains("@"))
    words = texts.select("doc_id", F.explode(likely).alias("word"))
    return words.filter(is_email("word"))


@query("f_case_filter", "select event_id, user_id, event_type from events where case when event_type = 'error' then user_id < 30 else true end")
def f_case_filter(spark, sf):
    df = table(spark, sf, "events")
    return df.filter(F.when(F.col("event_type") == "error", F.col("user_id") < 30).otherwise(True)).select("event_id", "user_id", "event_type")


@query(
    "x_cast",
    """select event_id, try_cast(value as integer) is null as no_int, cast(floor(value) as integer) as whole, cast(user_id as varchar) as user_text,
    cast(cast(ts as date) as varchar) as day, try_cast(event_type as bigint) is null as no_number from events""",
)
def x_cast(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.col("value").try_cast("int").isNull().alias("no_int"), F.floor("value").cast("int").alias("whole"),
        F.expr("string(user_id)").alias("user_text"), F.expr("date(ts)").cast("string").alias("day"), F.col("event_type").try_cast("long").isNull().alias("no_number"),
    )


@query(
    "x_case",
    """select p_partkey, case when p_size < 10 then 'small' when p_size < 30 then 'medium' else 'large' end as class from part""",
)
def x_case(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select("p_partkey", F.when(size < 10, "small").when(size < 30, "medium").otherwise("large").alias("class"))


@query("x_lit", "select distinct o_custkey, true as converted from orders")
def x_lit(spark, sf):
    return table(spark, sf, "orders").select("o_custkey").distinct().withColumn("converted", F.lit(True))


@query(
    "x_arith",
    """select l_orderkey, l_quantity + l_tax as a, l_extendedprice * 100 as b, case when l_discount <> 0 then l_tax / l_discount end as c,
    l_quantity >= 25 as big from lineitem""",
)
def x_arith(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", (F.col("l_quantity") + F.col("l_tax")).alias("a"), (F.col("l_extendedprice") * 100).alias("b"),
        F.try_divide("l_tax", "l_discount").alias("c"), (F.col("l_quantity") >= 25).alias("big"),
    )


# ---- joins --------------------------------------------------------------------------------------


@query(
    "j_null_safe",
    f"""with users as (select user_id, count(*) as n from {NULLED} group by 1)
    select e.event_id, u.n from {NULLED} e join users u on e.user_id is not distinct from u.user_id""",
)
def j_null_safe(spark, sf):
    """NULL keys meet. The right side has one row per key; a hot key on the left, NULL included, is split."""
    events = nulled_events(spark, sf).select("event_id", "user_id")
    users = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return join_hot_keys(events, users, ["user_id"], null_safe=True).select("event_id", "n")


@query(
    "j_inner_using",
    "select o_custkey as custkey, o_orderkey, c_name from orders join customer on o_custkey = c_custkey",
)
def j_inner_using(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return orders.join(customer, on="custkey", how="inner")


@query(
    "j_inner_expr",
    """select l_orderkey, l_partkey, p_partkey, p_brand from lineitem join part on l_partkey = p_partkey where p_size = 7""",
)
def j_inner_expr(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.struct("l_partkey", "l_quantity").alias("item"))
    part = table(spark, sf, "part").filter("p_size = 7")
    return lines.join(part, F.col("item.l_partkey") == part.p_partkey).select("l_orderkey", "item.l_partkey", "p_partkey", "p_brand")


@query(
    "j_explode_lookup",
    f"""select l_orderkey, kind, amount, p_name, p_type from {MEASURED} join part on l_partkey = p_partkey""",
)
def j_explode_lookup(spark, sf):
    """Unnest the measures of each line, and look up its part."""
    return spark.sql(
        """SELECT l_orderkey, m.kind, m.amount, p_name, p_type
           FROM (SELECT l_orderkey, l_partkey, explode(measures) AS m FROM {lines}) a
           INNER JOIN {part} b ON a.l_partkey = b.p_partkey""",
        lines=measured_lines(spark, sf), part=table(spark, sf, "part"),
    )


@query(
    "j_full_outer",
    """with buyers as (select distinct o_custkey, true as converted from orders where o_totalprice > 450000)
    select coalesce(c_custkey, o_custkey) as custkey, c_name, coalesce(converted, false) as converted
    from (select * from customer where c_acctbal > 0) full join buyers on c_custkey = o_custkey""",
)
def j_full_outer(spark, sf):
    """Both sides hold each key once, so no key can be large on either side."""
    customer = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("custkey"), "c_name")
    buyers = (
        table(spark, sf, "orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("custkey")).distinct()
        .withColumn("converted", F.lit(True))
    )
    return customer.join(buyers, "custkey", "full_outer").na.fill(False)


@query(
    "j_left",
    """select c_custkey, cast(o_orderkey as varchar) as order_text from customer left join orders on c_custkey = o_custkey""",
)
def j_left(spark, sf):
    placed = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return table(spark, sf, "customer").select("c_custkey").join(placed, "c_custkey", "left").select("c_custkey", F.col("o_orderkey").cast("string").alias("order_text"))


@query(
    "j_composite_left",
    """with rated as (select c_custkey, c_nationkey, c_mktsegment from customer where c_acctbal > 0),
    placed as (select o_orderkey, o_custkey, c_nationkey as nationkey from orders join customer on o_custkey = c_custkey)
    select o_orderkey, o_custkey, c_mktsegment from placed left join rated on c_custkey = o_custkey and c_nationkey = nationkey""",
)
def j_composite_left(spark, sf):
    customer = table(spark, sf, "customer")
    rated = customer.filter("c_acctbal > 0").select("c_custkey", "c_nationkey", "c_mktsegment")
    homes = customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nationkey"))
    placed = table(spark, sf, "orders").join(homes, "o_custkey")
    on = (F.col("c_custkey") == F.col("o_custkey")) & (F.col("c_nationkey") == F.col("nationkey"))
    return placed.join(rated, on, "left").select("o_orderkey", "o_custkey", "c_mktsegment")


@query(
    "j_alias_star",
    "select a.o_orderkey, a.o_custkey, a.o_orderstatus, b.c_name from orders a join customer b on a.o_custkey = b.c_custkey",
)
def j_alias_star(spark, sf):
    a = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").alias("a")
    b = table(spark, sf, "customer").alias("b")
    return a.join(b, F.col("a.o_custkey") == F.col("b.c_custkey")).select("a.*", "b.c_name")


@query(
    "j_multi_key",
    """with lines as (select l_partkey, l_suppkey, count(*) as n_lines from lineitem group by 1, 2),
    returned as (select l_partkey, l_suppkey, count(*) as n_returned from lineitem where l_returnflag = 'R' group by 1, 2)
    select l.l_partkey, l.l_suppkey, n_lines, coalesce(n_returned, 0) as n_returned from lines l left join returned r on l.l_partkey = r.l_partkey and l.l_suppkey = r.l_suppkey""",
)
def j_multi_key(spark, sf):
    keys = ["l_partkey", "l_suppkey"]
    line = table(spark, sf, "lineitem")
    lines = line.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_lines"))
    returned = line.filter("l_returnflag = 'R'").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_returned"))
    return lines.join(returned, keys, "left_outer").na.fill(0, ["n_returned"])


# ---- aggregation --------------------------------------------------------------------------------


@query("a_count", "select event_type, count(*) as count from events group by 1")
def a_count(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").count()


@query("a_multi_key", f"select n_name, r_name, count(*) as count from {PLACES} group by 1, 2")
def a_multi_key(spark, sf):
    return customer_places(spark, sf).groupBy("geo.n_name", "geo.r_name").count()


@query("a_sum_avg", "select l_returnflag, sum(l_linenumber)::bigint as lines, avg(l_quantity) as avg_qty from lineitem group by 1")
def a_sum_avg(spark, sf):
    grouped = table(spark, sf, "lineitem").groupBy("l_returnflag").agg({"l_linenumber": "sum", "l_quantity": "avg"})
    return grouped.withColumnsRenamed({"sum(l_linenumber)": "lines", "avg(l_quantity)": "avg_qty"})


@query("a_sum", "select l_returnflag, sum(l_linenumber)::bigint as lines, sum(l_quantity) as qty from lineitem group by 1")
def a_sum(spark, sf):
    """Whole-number values: the sums are exact in any order."""
    return table(spark, sf, "lineitem").groupBy("l_returnflag").sum("l_linenumber", "l_quantity").toDF("l_returnflag", "lines", "qty")


@query("a_avg", "select l_linestatus, avg(l_linenumber) as avg_line, avg(l_quantity) as avg_qty from lineitem group by 1")
def a_avg(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_linestatus").avg("l_linenumber", "l_quantity").toDF("l_linestatus", "avg_line", "avg_qty")


@query(
    "a_agg_alias",
    """select l_returnflag, l_linestatus, count(*) as n, sum(l_quantity) as sum_qty,
    round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue,
    round(avg(l_extendedprice), 4) as avg_price
    from lineitem group by 1, 2""",
)
def a_agg_alias(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty"), rounded_sum(net_price()).alias("revenue"),
        rounded_avg("l_extendedprice").alias("avg_price"),
    )


@query(
    "a_approx_distinct",
    """select event_type, count(distinct user_id) as users, true as within_bound from events group by 1""",
)
def a_approx_distinct(spark, sf):
    """The sketch next to the exact count: it has to be within three times its stated error."""
    counted = table(spark, sf, "events").groupBy("event_type", "user_id").count().groupBy("event_type").agg(
        F.count(F.lit(1)).alias("users"), F.approx_count_distinct("user_id", 0.05).alias("approx")
    )
    close = F.abs(F.col("approx") - F.col("users")) <= 0.15 * F.col("users")
    return counted.select("event_type", "users", close.alias("within_bound"))


@query("a_min_max", "select user_id, min(ts) as first_ts, max(ts) as last_ts, min(value) as low, max(event_type) as top_type from events group by 1")
def a_min_max(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.min("value").alias("low"), F.max("event_type").alias("top_type")
    )


@query("a_mean", "select p_brand, avg(p_size) as mean_size from part group by 1")
def a_mean(spark, sf):
    return table(spark, sf, "part").groupBy("p_brand").agg(F.mean("p_size").alias("mean_size"))


@query("a_count_nonnull", f"select count(*) as n, count(user_id) as users, count(value) as vals, count(event_type) as types from {NULLED}")
def a_count_nonnull(spark, sf):
    return nulled_events(spark, sf).agg(
        F.count(F.lit(1)).alias("n"), F.count("user_id").alias("users"), F.count("value").alias("vals"), F.count("event_type").alias("types")
    )


@query("a_count_if", f"select event_type, cast(count_if(value is null) as bigint) as missing from {NULLED} group by 1")
def a_count_if(spark, sf):
    return nulled_events(spark, sf).groupBy("event_type").agg(F.count_if(F.col("value").isNull()).alias("missing"))


@query(
    "a_count_distinct_tuple",
    "select count(*) as pairs from (select distinct l_partkey, l_suppkey from lineitem)",
)
def a_count_distinct_tuple(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count_distinct(F.struct("l_partkey", "l_suppkey")).alias("pairs"))


@query(
    "a_collect",
    """select p_brand, array_to_string(list_sort(list_distinct(list(p_size))), ',') as sizes, array_to_string(list_sort(list(distinct p_type)), ',') as types
    from part group by 1""",
)
def a_collect(spark, sf):
    """Sets of values from small domains: their size cannot grow with the rows of a group."""
    return table(spark, sf, "part").groupBy("p_brand").agg(
        F.array_join(F.sort_array(F.collect_set("p_size")).cast("array<string>"), ",").alias("sizes"),
        F.array_join(F.sort_array(F.collect_set("p_type")), ",").alias("types"),
    )


@query(
    "a_flatten_distinct",
    """select o_orderpriority, array_to_string(list_sort(list(distinct p_brand)), ',') as brands
    from orders join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey group by 1""",
)
def a_flatten_distinct(spark, sf):
    """Distinct brands over the brand arrays of all sales.

    The set of arrays could be as large as the table. The arrays are reduced to their distinct
    elements first, so what is flattened per group is bounded by the number of brands.
    """
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")
    per_sale = lines.groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("brands"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    each = orders.join(per_sale, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderpriority", F.explode("brands").alias("brand"))
    sets = each.groupBy("o_orderpriority", "brand").agg(F.array(F.col("brand")).alias("one"))
    flat = sets.groupBy("o_orderpriority").agg(F.array_distinct(F.flatten(F.collect_set("one"))).alias("brands"))
    return flat.select("o_orderpriority", F.array_join(F.sort_array("brands"), ",").alias("brands"))


@query("a_first", "select event_type, arg_min(event_id, ts) as first_event from events group by 1")
def a_first(spark, sf):
    """The first event of a type by time. ``first`` alone would depend on the order of arrival."""
    return table(spark, sf, "events").groupBy("event_type").agg(F.min_by("event_id", "ts").alias("first_event"))


@query(
    "a_stats",
    """select l_returnflag, round(stddev_samp(l_quantity), 6) as sd, round(var_pop(l_quantity), 6) as var, round(corr(l_quantity, l_extendedprice), 6) as r,
    sum(distinct l_quantity) as sum_dist from lineitem group by 1""",
)
def a_stats(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.stddev_samp("l_quantity"), 6).alias("sd"), F.round(F.var_pop("l_quantity"), 6).alias("var"),
        F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"), F.sum_distinct("l_quantity").alias("sum_dist"),
    )


@query("a_sum_bool", "select o_orderpriority, sum(cast(o_orderstatus = 'F' as integer))::bigint as finished from orders group by 1")
def a_sum_bool(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.sum((F.col("o_orderstatus") == "F").cast("int")).alias("finished"))


@query(
    "a_pivot_sql",
    """select user_id, nullif(count(*) filter (event_type = 'click'), 0) as click, nullif(count(*) filter (event_type = 'view'), 0) as view,
    nullif(count(*) filter (event_type = 'purchase'), 0) as purchase from events group by 1""",
)
def a_pivot_sql(spark, sf):
    return spark.sql(
        """SELECT * FROM (SELECT user_id, event_type FROM {events})
           PIVOT (count(*) FOR event_type IN ('click' AS click, 'view' AS view, 'purchase' AS purchase))""",
        events=table(spark, sf, "events"),
    )


@query(
    "a_pivot_df",
    """select l_suppkey, sum(l_quantity) filter (l_returnflag = 'A') as a, sum(l_quantity) filter (l_returnflag = 'N') as n,
    sum(l_quantity) filter (l_returnflag = 'R') as r from lineitem group by 1""",
)
def a_pivot_df(spark, sf):
    pivoted = table(spark, sf, "lineitem").groupBy("l_suppkey").pivot("l_returnflag", ["A", "N", "R"]).sum("l_quantity")
    return pivoted.toDF("l_suppkey", "a", "n", "r")


@query(
    "a_nested",
    """select max(n) <= 1 as no_duplicates from (select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2)""",
)
def a_nested(spark, sf):
    return cleaning.is_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "a_dedup",
    f"""select user_id, event_type, max(value) as value, max(ts) as ts from {NULLED} where user_id is not null group by 1, 2""",
)
def a_dedup(spark, sf):
    return cleaning.collapse(nulled_events(spark, sf), ["user_id", "event_type"], ["value", "ts"])


@query(
    "a_summary",
    """with c as (select count(*)::varchar as c, min(p_size)::varchar as lo, max(p_size)::varchar as hi from part)
    select 'count' as summary, c as p_size from c union all select 'min', lo from c union all select 'max', hi from c""",
)
def a_summary(spark, sf):
    return table(spark, sf, "part").select("p_size").summary("count", "min", "max")


# ---- time windows -------------------------------------------------------------------------------


@query(
    "w_tumbling",
    """select user_id, time_bucket(interval 3 minutes, ts) + interval 3 minutes as window_end, count(*) as n, max(value) as top
    from events group by 1, 2""",
)
def w_tumbling(spark, sf):
    grouped = table(spark, sf, "events").groupBy("user_id", F.window("ts", "3 minutes").alias("w"))
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top")).select("user_id", F.col("w.end").alias("window_end"), "n", "top")


# ---- order and limits ---------------------------------------------------------------------------


@query("o_sort", "select o_orderkey, o_orderpriority, o_totalprice from orders order by 2, 3 desc, 1")
def o_sort(spark, sf):
    """The unique last key also keeps rows of one hot priority from landing in one range."""
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return df.orderBy(F.col("o_orderpriority"), F.col("o_totalprice").desc(), F.col("o_orderkey"))


@query("o_nulls_last", f"select event_id, value from {NULLED} order by value desc nulls last, event_id")
def o_nulls_last(spark, sf):
    return nulled_events(spark, sf).select("event_id", "value").orderBy(F.col("value").desc_nulls_last(), "event_id")


@query("o_limit", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem order by all limit 100")
def o_limit(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return df.orderBy(*df.columns).limit(100)


@query(
    "o_topk",
    """select l_suppkey, round(sum(l_extendedprice), 2) as total_rev from lineitem group by 1 order by 2 desc, 1 limit 3""",
)
def o_topk(spark, sf):
    totals = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(rounded_sum("l_extendedprice").alias("total_rev"))
    return totals.sort(F.col("total_rev").desc(), "l_suppkey").limit(3)


# ---- sets ---------------------------------------------------------------------------------------


@query("x_union_all", "select c_name as name, c_acctbal as balance from customer union all select s_name, s_acctbal from supplier")
def x_union_all(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return customers.union(table(spark, sf, "supplier").select("s_name", "s_acctbal"))


@query("x_distinct", "select distinct user_id, event_type from events")
def x_distinct(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type").distinct()


@query("x_dedup_subset", "select distinct l_partkey, l_suppkey from lineitem")
def x_dedup_subset(spark, sf):
    return table(spark, sf, "lineitem").dropDuplicates(["l_partkey", "l_suppkey"]).select("l_partkey", "l_suppkey")


@query(
    "x_union_by_name",
    "select c_custkey as id, c_name as name, c_mktsegment as segment from customer union all select s_suppkey, s_name, null from supplier",
)
def x_union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query(
    "arr_explode",
    f"""select l_orderkey, kind, count(*) as n, sum(amount) as total from {MEASURED} group by 1, 2""",
)
def arr_explode(spark, sf):
    each = unnest(measured_lines(spark, sf), "measures").select("l_orderkey", "item.kind", "item.amount")
    return each.groupBy("l_orderkey", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
