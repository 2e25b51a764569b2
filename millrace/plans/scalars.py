"""Scalar functions: text, time, numbers, NULLs, arrays, JSON and user-defined functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import numbers, text, times, udfs
from millrace.plans.registry import query
from millrace.plans.relational import NULLED, measured_lines, nulled_events
from millrace.sources.loader import infer_json_schema
from millrace.tables import table

# Stand-in e-mail addresses: the customer's name at a host named after the market segment.
EMAIL = "replace(lower(c_name), '#', '.') || '@' || lower(c_mktsegment) || '.example.com'"


def emails(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.expr(EMAIL).alias("email"))


EMAILS = f"(select c_custkey, {EMAIL} as email from customer)"


# ---- text ---------------------------------------------------------------------------------------


@query("s_split", f"select c_custkey, string_split(email, '@')[1] as account, string_split(email, '@')[2] as host from {EMAILS}")
def s_split(spark, sf):
    parts = F.split("email", "@", 0)
    return emails(spark, sf).select("c_custkey", parts[0].alias("account"), parts[1].alias("host"))


@query("s_regex_extract", f"select c_custkey, split_part(email, '@', 2) as domain from {EMAILS}")
def s_regex_extract(spark, sf):
    return emails(spark, sf).select("c_custkey", text.email_domain("email").alias("domain"))


@query(
    "s_clean",
    r"""select doc_id, regexp_replace(text, '\s+', ' ', 'g') as spaced, length(translate(text, 'aeiou', '12345')) as n,
    md5(ltrim(translate(lower(text), 'aeiou', '12345'))) as digest from documents""",
)
def s_clean(spark, sf):
    df = table(spark, sf, "documents")
    return df.select(
        "doc_id", F.regexp_replace("text", r"\s+", " ").alias("spaced"), F.length(F.translate("text", "aeiou", "12345")).cast("long").alias("n"),
        F.md5(F.ltrim(F.translate(F.lower("text"), "aeiou", "12345"))).alias("digest"),
    )


@query(
    "s_concat",
    "select p_partkey, p_brand || ' / ' || p_type || ': about ' || cast(cast(round(p_retailprice, 0) as bigint) as varchar) as label from part",
)
def s_concat(spark, sf):
    price = F.round("p_retailprice", 0).cast("long")
    return table(spark, sf, "part").select("p_partkey", F.concat("p_brand", F.lit(" / "), "p_type", F.lit(": about "), price).alias("label"))


@query("s_mask_tail", "select c_custkey, repeat('*', (length(c_name) - 2)::integer) || right(c_name, 2) as masked from customer")
def s_mask_tail(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.mask_tail("c_name").alias("masked"))


@query("s_first_char", "select doc_id, left(text, 1) as first_char from documents")
def s_first_char(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.first_char("text").alias("first_char"))


# ---- date and time ------------------------------------------------------------------------------


@query("d_from_micros", "select event_id, epoch_us(ts) as micros, ts as again from events")
def d_from_micros(spark, sf):
    df = table(spark, sf, "events").select("event_id", times.to_micros("ts").alias("micros"))
    return df.withColumn("again", times.from_micros("micros"))


@query(
    "d_format",
    """select event_id, strftime(ts, '%B %d, %Y') as long_date, strftime(ts, '%H:%M:%S.%f') as clock, strftime(ts, '%b %-d, %Y') as short_date from events""",
)
def d_format(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "MMMM dd, yyyy").alias("long_date"), F.date_format("ts", "HH:mm:ss.SSSSSS").alias("clock"),
        F.date_format("ts", "MMM d, yyyy").alias("short_date"),
    )


@query(
    "d_extract",
    """select event_id, year(ts)::integer as y, month(ts)::integer as m, (dayofweek(ts) + 1)::integer as dow, minute(ts)::integer as mi,
    second(ts)::integer as s from events""",
)
def d_extract(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofweek("ts").alias("dow"), F.minute("ts").alias("mi"), F.second("ts").alias("s")
    )


@query("d_to_date", "select cast(cast(ts as date) as varchar) as day, count(*) as n from events group by 1")
def d_to_date(spark, sf):
    return table(spark, sf, "events").groupBy(F.to_date("ts").cast("string").alias("day")).count().withColumnRenamed("count", "n")


@query("d_add", "select o_orderkey, cast(cast(o_orderdate as date) + 2 as varchar) as due from orders")
def d_add(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.date_add("o_orderdate", 2).cast("string").alias("due"))


@query("d_trunc", "select date_trunc('day', ts) as day, max(value) as top from events group by 1")
def d_trunc(spark, sf):
    return table(spark, sf, "events").groupBy(times.day_of("ts").alias("day")).agg(F.max("value").alias("top"))


@query(
    "d_unixtime",
    """select event_id, epoch(date_trunc('second', ts))::bigint as secs, strftime(ts, '%Y-%m-%d %H:%M:%S') as as_text, date_trunc('second', ts) as again from events""",
)
def d_unixtime(spark, sf):
    df = table(spark, sf, "events").select("event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("secs"))
    as_text = F.from_unixtime("secs")
    return df.select("event_id", "secs", as_text.alias("as_text"), as_text.cast("timestamp_ntz").alias("again"))


@query("d_parse", "select event_id, date_trunc('second', ts) as parsed, cast(null as timestamp) as bad from events")
def d_parse(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"))
    pattern = F.lit("yyyy-MM-dd HH:mm:ss")
    return df.select(
        "event_id", F.to_timestamp("t", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("parsed"),
        F.try_to_timestamp("event_type", pattern).cast("timestamp_ntz").alias("bad"),
    )


@query(
    "d_months",
    """select o_orderkey, cast(cast(o_orderdate + interval 3 months as date) as varchar) as later, day(o_orderdate)::integer as dom, true as past from orders""",
)
def d_months(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.add_months("o_orderdate", 3).cast("string").alias("later"), F.dayofmonth("o_orderdate").alias("dom"),
        (F.current_timestamp() > F.col("o_orderdate").cast("timestamp")).alias("past"),
    )


# ---- numbers ------------------------------------------------------------------------------------


@query(
    "m_math",
    """select event_id, round(sqrt(value), 6) as root, round(cos(value), 6) as cosine, ceil(value)::bigint as up, round(ln(value + 1), 6) as nat,
    round(value, 1) as rounded from events""",
)
def m_math(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").select(
        "event_id", F.round(F.sqrt(v), 6).alias("root"), F.round(F.cos(v), 6).alias("cosine"), F.ceil(v).alias("up"),
        F.round(F.log(v + 1), 6).alias("nat"), F.round(v, 1).alias("rounded"),
    )


@query("m_trunc", "select l_orderkey, cast(trunc(l_extendedprice * l_discount * 100) as bigint) / 100 as cut from lineitem")
def m_trunc(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", numbers.cut_decimals(F.col("l_extendedprice") * F.col("l_discount")).alias("cut"))


@query("m_rand", "select event_id, true as in_range from events")
def m_rand(spark, sf):
    draw = (F.rand(7) * 250).cast("int")
    df = table(spark, sf, "events").select("event_id", draw.alias("draw"), (F.rand(8) > 0.25).alias("coin"))
    return df.select("event_id", (F.col("draw").between(0, 249) & F.col("coin").isNotNull()).alias("in_range"))


# ---- NULLs --------------------------------------------------------------------------------------


@query("n_drop", f"select event_id, user_id, value from {NULLED} where user_id is not null and value is not null")
def n_drop(spark, sf):
    return nulled_events(spark, sf).select("event_id", "user_id", "value").na.drop()


@query("n_drop_all", f"select event_id, cast(user_id as varchar) as user_text, value from {NULLED} where user_id is not null or value is not null")
def n_drop_all(spark, sf):
    return nulled_events(spark, sf).select("event_id", "user_id", "value").na.drop("all", subset=["user_id", "value"]).select("event_id", F.col("user_id").cast("string").alias("user_text"), "value")


@query("n_fill", f"select event_id, coalesce(user_id, -1) as user_id, coalesce(value, 0.0) as value from {NULLED}")
def n_fill(spark, sf):
    return nulled_events(spark, sf).select("event_id", "user_id", "value").na.fill({"user_id": -1, "value": 0.0})


@query("n_replace", "select event_id, case event_type when 'error' then 'failure' when 'view' then 'visit' else event_type end as event_type from events")
def n_replace(spark, sf):
    return table(spark, sf, "events").select("event_id", "event_type").na.replace({"error": "failure", "view": "visit"}, subset=["event_type"])


# ---- arrays -------------------------------------------------------------------------------------


@query(
    "arr_field",
    """select l_orderkey, l_partkey, l_quantity::bigint || '/' || l_linenumber as amounts from lineitem""",
)
def arr_field(spark, sf):
    amounts = F.array_join(F.col("measures.amount").cast("array<bigint>").cast("array<string>"), "/")
    return measured_lines(spark, sf).select("l_orderkey", "l_partkey", amounts.alias("amounts"))


@query(
    "arr_access",
    r"""select doc_id, list_contains(w, 'the') as has_the, w[2] as second, len(w)::integer as n from (select doc_id, string_split(text, ' ') as w from documents)
    where len(w) > 2""",
)
def arr_access(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("w"))
    return words.filter(F.size("w") > 2).select(
        "doc_id", F.array_contains("w", "the").alias("has_the"), F.try_element_at("w", F.lit(2)).alias("second"), F.size("w").alias("n")
    )


@query(
    "arr_filter",
    """select vec_id, len(list_filter(embedding, lambda x: x > 0))::integer as positives from embeddings
    where len(list_filter(embedding, lambda x: x > 0)) > 0""",
)
def arr_filter(spark, sf):
    kept = table(spark, sf, "embeddings").select("vec_id", F.filter("embedding", lambda x: x > 0).alias("kept"))
    return kept.filter(F.size("kept") > 0).select("vec_id", F.size("kept").alias("positives"))


@query(
    "arr_transform",
    """select vec_id, array_to_string(list_transform(embedding, lambda x: cast(trunc(cast(x as double) * 100) as integer)), ',') as cents from embeddings""",
)
def arr_transform(spark, sf):
    cents = F.transform("embedding", lambda x: (x.cast("double") * 100).cast("int"))
    return table(spark, sf, "embeddings").select("vec_id", F.array_join(cents.cast("array<string>"), ",").alias("cents"))


@query(
    "arr_exists",
    """select doc_id, len(list_filter(string_split(text, ' '), lambda w: ends_with(w, 'tion'))) > 0 as found from documents""",
)
def arr_exists(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.exists(F.split("text", " "), lambda w: w.like("%tion")).alias("found"))


@query(
    "arr_reduce",
    """select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: cast(x as double) * cast(x as double)))), 6) as norm from embeddings""",
)
def arr_reduce(spark, sf):
    norm = F.reduce("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"), lambda acc: F.round(F.sqrt(acc), 6))
    return table(spark, sf, "embeddings").select("vec_id", norm.alias("norm"))


# ---- JSON ---------------------------------------------------------------------------------------


@query("js_path", "select event_id, props->>'$.k' as k from events where cast(props->>'$.k' as integer) < 20")
def js_path(spark, sf):
    df = table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))
    return df.filter(F.col("k").try_cast("int") < 20)


@query("js_parse", "select event_id, cast(props->>'$.k' as bigint) as k from events")
def js_parse(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "STRUCT<k: BIGINT>").alias("json")).select("event_id", "json.*")


@query("js_schema", "select 'STRUCT<k: BIGINT>' as found, count(*) as n from events where props->>'$.k' is not null")
def js_schema(spark, sf):
    """The schema over all texts, and how many texts an example document's schema parses."""
    df = table(spark, sf, "events")
    example = F.schema_of_json(F.lit('{"k": 1}'))
    found = infer_json_schema(df, "props")
    return df.agg(F.count(F.from_json("props", example)["k"]).alias("n")).select(F.lit(found).alias("found"), "n")


@query("js_binary_text", "select event_id, event_type as key, props as value from events")
def js_binary_text(spark, sf):
    enveloped = table(spark, sf, "events").select("event_id", F.col("event_type").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"))
    return enveloped.select("event_id", F.col("key").cast("string").alias("key"), F.expr("string(value)").alias("value"))


# ---- user-defined functions ---------------------------------------------------------------------


@query(
    "udf_sql",
    """select o_orderkey, year(o_orderdate) || '-' || lpad(o_custkey::varchar, 9, '0') as archive_box,
    (case o_orderstatus when 'F' then 0 else 10 end + case when left(o_orderpriority, 1) in ('1', '2') then 5 else 1 end)::integer as effort from orders""",
)
def udf_sql(spark, sf):
    udfs.define_sql_function(
        spark, "archive_box", "placed TIMESTAMP_NTZ, customer BIGINT", "STRING", "concat(year(placed), '-', lpad(cast(customer AS STRING), 9, '0'))"
    )
    udfs.define_sql_function(
        spark, "order_effort", "status STRING, priority STRING", "INT", "if(status = 'F', 0, 10) + if(left(priority, 1) IN ('1', '2'), 5, 1)"
    )
    return spark.sql(
        "SELECT o_orderkey, archive_box(o_orderdate, o_custkey) AS archive_box, order_effort(o_orderstatus, o_orderpriority) AS effort FROM {orders}",
        orders=table(spark, sf, "orders"),
    )


@query("udf_python", "select c_custkey, left(c_mktsegment, 1) as letter from customer")
def udf_python(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", udfs.first_letter_rowwise()("c_mktsegment").alias("letter"))


@query("udf_pandas", "select c_custkey, left(c_mktsegment, 1) as letter from customer")
def udf_pandas(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", udfs.first_letter_vectorised()("c_mktsegment").alias("letter"))


@query("udf_registered", "select o_orderkey, left(o_orderpriority, 1) as letter from orders")
def udf_registered(spark, sf):
    udfs.register_first_letter(spark)
    return spark.sql("SELECT o_orderkey, first_letter(o_orderpriority) AS letter FROM {orders}", orders=table(spark, sf, "orders"))
