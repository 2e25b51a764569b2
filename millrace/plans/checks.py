"""Expectations, event-log reports, alerts, views and protection of rows and columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.numbers import rounded_avg
from millrace.functions.text import EMAIL_PATTERN
from millrace.operators import protect, quality
from millrace.operators.quality import DROP, FAIL, WARN, Expectation
from millrace.plans.registry import query
from millrace.plans.relational import NULLED, nulled_events
from millrace.plans.scalars import EMAIL
from millrace.session import scratch
from millrace.streaming import datasets as D
from millrace.tables import table

# ---- expectations -------------------------------------------------------------------------------


@query(
    "q_expect_warn",
    f"""select 'events' as dataset, 'has_user' as name, count(*) filter (user_id is not null) as passed_records, count(*) filter (user_id is null) as failed_records from {NULLED}""",
)
def q_expect_warn(spark, sf):
    return quality.expectation_counts(nulled_events(spark, sf), [Expectation("has_user", "user_id IS NOT NULL", WARN)], "events")


@query("q_expect_drop", f"select event_id, event_type, value from {NULLED} where coalesce(value > 10, false)")
def q_expect_drop(spark, sf):
    """A NULL value breaks the rule as well."""
    df = nulled_events(spark, sf).select("event_id", "event_type", "value")
    return quality.keep_expected(df, [Expectation("large", "value > 10", DROP)])


@query("q_expect_fail", "select o_orderkey, o_totalprice, true as refused from orders")
def q_expect_fail(spark, sf):
    """A good load goes through; one with a broken row leaves nothing behind."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    good, bad = scratch(spark, "good"), scratch(spark, "bad")
    quality.write_expected(orders, [Expectation("priced", "o_totalprice >= 0", FAIL)], good, "orders")
    try:
        quality.write_expected(orders, [Expectation("cheap", "o_totalprice < 1000", FAIL)], bad, "orders")
        refused = False
    except quality.ExpectationFailed:
        refused = True
    return spark.read.parquet(good).withColumn("refused", F.lit(refused))


def mailing_rules():
    return [
        Expectation("numbered", "c_custkey >= 0", FAIL),
        Expectation("has_segment", "segment IS NOT NULL", DROP),
        Expectation("mail_shaped", F.col("mail").rlike(EMAIL_PATTERN), DROP),
        Expectation("solvent", "c_acctbal >= 0"),
    ]


def mailing_list(spark, sf):
    """Customers to write to, with gaps: a nation without segments, and one segment with broken addresses."""
    return table(spark, sf, "customer").select(
        "c_custkey", "c_acctbal", F.when(F.col("c_nationkey") != 7, F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_mktsegment") == "FURNITURE", F.col("c_name")).otherwise(F.expr(EMAIL)).alias("mail"),
    )


MAILING = f"""(select c_acctbal >= 0 as solvent, c_nationkey <> 7 as segment,
    regexp_matches(case when c_mktsegment = 'FURNITURE' then c_name else {EMAIL} end, '{EMAIL_PATTERN}') as mail from customer)"""


@query(
    "q_multi",
    f"""with f as {MAILING}, k as (select count(*) filter (segment and mail) as kept, count(*) as n, count(*) filter (segment) as segment,
        count(*) filter (mail) as mail, count(*) filter (solvent) as solvent from f)
    select name, passed_records, n - passed_records as failed_records, kept from (
    select n, kept, unnest(['numbered', 'has_segment', 'mail_shaped', 'solvent']) as name, unnest([n, segment, mail, solvent]) as passed_records from k)""",
)
def q_multi(spark, sf):
    """Four rules, counted in the pass that writes the rows."""
    path = scratch(spark, "clean")
    counts = quality.write_expected(mailing_list(spark, sf), mailing_rules(), path, "customers")
    kept = spark.read.parquet(path).count()
    return counts.select("name", "passed_records", "failed_records").withColumn("kept", F.lit(kept).cast("long"))


@query(
    "q_quarantine",
    f"""select event_id, concat_ws(',', case when not coalesce(value > 10, false) then 'large' end, case when user_id is null then 'has_user' end,
        case when not coalesce(event_type <> 'error', false) then 'sound' end) as broken,
        count(*) over () as n_rejected, count(*) filter (not coalesce(value > 10, false)) over () as n_large from {NULLED}
    where not (coalesce(value > 10, false) and coalesce(event_type <> 'error', false))""",
)
def q_quarantine(spark, sf):
    """Rows that drop rules keep out, with all rules they break, from the write that keeps the others, and the counts of that write."""
    rules = [Expectation("large", "value > 10", DROP), Expectation("has_user", "user_id IS NOT NULL"), Expectation("sound", "event_type <> 'error'", DROP)]
    path = scratch(spark, "judged")
    rows = nulled_events(spark, sf).select("event_id", "event_type", "user_id", "value")
    found = quality.write_judged(rows, rules, path)
    counts = {name: failed for _, name, _, failed in quality.rule_counts(found, rules, "events")}
    rejected = quality.read_rejected(spark.read, path, rows.schema)
    n = sum(k for names, k in found.items() if {"large", "sound"} & set(names.split(",")))
    # Dropping looks at the rules' verdict, so a large row without a user stays.
    return rejected.select("event_id", F.array_join("broken", ",").alias("broken"), F.lit(n).cast("long").alias("n_rejected"), F.lit(counts["large"]).cast("long").alias("n_large"))


@query(
    "q_metrics",
    f"""select dataset, expectation, sum(ok)::bigint as passing_records, sum(bad)::bigint as failing_records from (
    select event_type as dataset, 'has_value' as expectation, count(value) as ok, count(*) - count(value) as bad from {NULLED} group by 1
    union all select event_type, 'large', count(*) filter (value > 20), count(*) filter (value is null or value <= 20) from {NULLED} group by 1) group by 1, 2""",
)
def q_metrics(spark, sf):
    """Metric rows of many runs (one per user and day here) summed per dataset and rule."""
    runs = nulled_events(spark, sf).groupBy(F.col("event_type").alias("dataset"), "user_id", F.to_date("ts").alias("run")).agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("has_value"), F.count_if(F.coalesce(F.col("value") > 20, F.lit(False))).alias("large")
    )
    each = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("passed_records"), (F.col("n") - F.col(c)).alias("failed_records")) for c in ("has_value", "large")])
    metrics = runs.select("dataset", F.inline(each))
    return quality.metrics_report(metrics)


# ---- event log ----------------------------------------------------------------------------------


def event_log(spark, sf):
    """Events in the shape of a run log: the update is the day, details are JSON."""
    user = F.concat(F.lit("user"), F.col("user_id").cast("string"))
    k = F.get_json_object("props", "$.k")
    details = (
        F.when(F.col("event_type") == "click", F.to_json(F.struct(F.struct(k.alias("action"), user.alias("user_name")).alias("user_action"))))
        .when(F.col("event_type") == "view", F.to_json(F.struct(F.struct(k.alias("output_dataset"), F.array(user).alias("input_datasets")).alias("flow_definition"))))
        .when(
            F.col("event_type") == "purchase",
            F.to_json(F.struct(F.struct(F.struct(F.array(F.struct(
                F.lit("rule").alias("name"), k.alias("dataset"), F.col("user_id").alias("passed_records"), F.lit(1).alias("failed_records")
            )).alias("expectations")).alias("data_quality")).alias("flow_progress"))),
        )
    )
    kinds = F.create_map(*[F.lit(x) for pair in (("click", "user_action"), ("view", "flow_definition"), ("purchase", "flow_progress"), ("signup", "create_update"), ("error", "error")) for x in pair])
    return table(spark, sf, "events").select(
        kinds[F.col("event_type")].alias("event_type"), F.col("ts").alias("timestamp"),
        F.struct(F.date_format("ts", "yyyy-MM-dd").alias("update_id")).alias("origin"), details.alias("details"),
    )


@query(
    "q_event_log",
    """select props->>'$.k' as output_dataset, '["user' || user_id || '"]' as input_datasets from events
    where event_type = 'view' and cast(ts as date) = (select cast(max(ts) as date) from events where event_type = 'signup')""",
)
def q_event_log(spark, sf):
    """Lineage in the newest update."""
    return quality.lineage(quality.of_latest_update(event_log(spark, sf)))


@query("q_user_actions", "select ts as timestamp, props->>'$.k' as action, 'user' || user_id as user_name from events where event_type = 'click'")
def q_user_actions(spark, sf):
    return quality.user_actions(event_log(spark, sf))


@query(
    "q_event_metrics",
    """with e as (select event_type, value, user_id from events), c as (select * from e where value > 20)
    select 'kept' as dataset, 'large' as expectation, count(*) filter (value > 20) as passing_records, count(*) filter (not value > 20) as failing_records from e
    union all select 'kept', 'no_error', count(*) filter (event_type <> 'error'), count(*) filter (event_type = 'error') from e
    union all select 'by_user', 'seen_twice', count(*) filter (n > 1), count(*) filter (n <= 1) from (select user_id, count(*) as n from c group by 1)""",
)
def q_event_metrics(spark, sf):
    """Expectation counts in the log that two runs of a dataset graph have left, of the newest run."""
    sets = D.Datasets(spark, scratch(spark, "sets"))

    @sets.dataset(D.TABLE, expectations=[Expectation("large", "value > 20", DROP), Expectation("no_error", "event_type <> 'error'")])
    def kept(s):
        return table(spark, sf, "events").select("event_type", "value", "user_id")

    @sets.dataset(D.TABLE, expectations=[Expectation("seen_twice", "n > 1")])
    def by_user(s):
        return s.read("kept").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))

    sets.run()
    sets.run()
    return quality.metrics_report(quality.expectation_events(quality.of_latest_update(sets.events())))


@query("q_threshold", "select user_id, count(*) as total_records from events group by 1 having count(*) > 70")
def q_threshold(spark, sf):
    totals = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("total_records"))
    return quality.over_threshold(totals, "total_records", 70)


# ---- views and protection -----------------------------------------------------------------------


@query(
    "v_daily_avg",
    """select user_id, date_trunc('day', ts) as day, round(avg(value), 4) as avg_value from events group by 1, 2""",
)
def v_daily_avg(spark, sf):
    daily = table(spark, sf, "events").groupBy("user_id", F.date_trunc("DD", "ts").cast("timestamp_ntz").alias("day")).agg(rounded_avg("value").alias("avg_value"))
    daily.createOrReplaceTempView("millrace_daily_avg")
    return spark.sql("SELECT * FROM millrace_daily_avg")


def entitlements(spark, sf):
    """Who belongs to which group: customers, by market segment."""
    return table(spark, sf, "customer").select(F.col("c_name").alias("user_name"), F.col("c_mktsegment").alias("group_name"))


@query(
    "v_redact",
    """select c_custkey, case when m then 'REDACTED' else c_name end as c_name, case when m then 'REDACTED' else cast(c_nationkey as varchar) end as c_nationkey, c_mktsegment
    from customer, (select count(*) > 0 as m from customer where c_name = 'Customer#000000001' and c_mktsegment = 'MACHINERY')""",
)
def v_redact(spark, sf):
    restricted = "MACHINERY" in protect.groups_of(entitlements(spark, sf), "Customer#000000001")
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return protect.redact(df, ["c_name", "c_nationkey"], restricted)


@query("v_mask", "select s_suppkey, repeat('*', (length(s_name) - 2)::integer) || right(s_name, 2) as s_name from supplier")
def v_mask(spark, sf):
    return protect.mask_columns(table(spark, sf, "supplier").select("s_suppkey", "s_name"), ["s_name"])


@query("v_row_filter", "select event_id, user_id, value from events where case when event_type = 'error' then user_id < 30 else true end")
def v_row_filter(spark, sf):
    """Rows of a restricted kind are shown only for low device numbers."""
    df = table(spark, sf, "events")
    return protect.filter_rows(df, F.col("event_type") == "error", "user_id < 30").select("event_id", "user_id", "value")
