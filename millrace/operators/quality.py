"""Row expectations: keep, drop or fail on rows that break a rule, and count them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import storage

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Expectation:
    """``predicate`` has to be true; false and NULL both break it."""

    name: str
    predicate: Column | str
    on_violation: str = WARN

    def __post_init__(self):
        if self.on_violation not in (WARN, DROP, FAIL):
            raise ValueError(f"on_violation must be warn, drop or fail, not {self.on_violation}")

    def holds(self) -> Column:
        predicate = F.expr(self.predicate) if isinstance(self.predicate, str) else self.predicate
        return F.coalesce(predicate, F.lit(False))


class ExpectationFailed(ValueError):
    pass


def _all_hold(expectations: list[Expectation]) -> Column:
    return reduce(lambda a, b: a & b, [e.holds() for e in expectations], F.lit(True))


def keep_expected(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """The rows that go on: those that meet every ``drop`` rule.

    A row that breaks a ``fail`` rule stops the job when it is reached. Works on streams.
    """
    for e in expectations:
        if e.on_violation == FAIL:
            broken = F.raise_error(F.lit(f"expectation {e.name} failed")).cast("boolean")
            # The task number is never negative. It keeps the optimiser from moving the test below a join
            # or another filter, where it would fail on rows that never get here.
            df = df.filter(F.when(e.holds(), F.lit(True)).when(F.spark_partition_id() < 0, F.lit(True)).otherwise(broken))
    drops = [e for e in expectations if e.on_violation == DROP]
    return df.filter(_all_hold(drops)) if drops else df


def expectation_counts(df: DataFrame, expectations: list[Expectation], dataset: str) -> DataFrame:
    """One row per rule: dataset, name, passed and failed records. One pass over the rows."""
    totals = df.agg(*[F.count_if(e.holds()).alias(f"ok{i}") for i, e in enumerate(expectations)], F.count(F.lit(1)).alias("n"))
    report = F.array(*[
        F.struct(F.lit(e.name).alias("name"), F.col(f"ok{i}").alias("passed_records"), (F.col("n") - F.col(f"ok{i}")).alias("failed_records"))
        for i, e in enumerate(expectations)
    ])
    return totals.select(F.explode(report).alias("r")).select(F.lit(dataset).alias("dataset"), "r.name", "r.passed_records", "r.failed_records")


def observed(df: DataFrame, expectations: list[Expectation], into: Observation | str) -> DataFrame:
    """Count records and violations in whatever pass reads the frame, batch or stream.

    The counts are metrics: a stage that Spark has to run again may count a row twice.
    """
    counts = [F.count_if(~e.holds()).alias(e.name) for e in expectations]
    return df.observe(into, F.count(F.lit(1)).alias("records"), *counts)


VERDICT, BROKEN = "__verdict", "__broken"
KEPT, REJECTED, NONE = "kept", "rejected", "-"


def judged(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """Rows with their verdict (kept or rejected) and the names of the rules they break, joined by commas.

    A broken ``fail`` rule stops the job. Rule names may not hold a comma.
    """
    if any("," in e.name for e in expectations):
        raise ValueError("the name of a rule may not hold a comma")
    df = keep_expected(df, [e for e in expectations if e.on_violation == FAIL])
    drops = [e for e in expectations if e.on_violation == DROP]
    broken = F.concat_ws(",", *[F.when(~e.holds(), F.lit(e.name)) for e in expectations if e.on_violation != FAIL])
    verdict = F.when(_all_hold(drops), F.lit(KEPT)).otherwise(F.lit(REJECTED))
    return df.withColumns({VERDICT: verdict, BROKEN: F.when(F.length(broken) > 0, broken).otherwise(F.lit(NONE))})


def rule_counts(found: dict[str, int], expectations: list[Expectation], dataset: str) -> list[tuple[str, str, int, int]]:
    """(dataset, rule, passed, failed) from the rows of each value of the broken rules."""
    total = sum(found.values())
    failed = {e.name: sum(n for names, n in found.items() if e.name in names.split(",")) for e in expectations}
    return [(dataset, e.name, total - failed[e.name], failed[e.name]) for e in expectations]


def write_judged(df: DataFrame, expectations: list[Expectation], path: str) -> dict[str, int]:
    """Write kept and rejected rows in one pass, a folder for each verdict; returns rows by their broken rules.

    The rows are counted by the footers of the files that were committed, so a task that ran twice counts once.
    """
    spark = df.sparkSession
    judged(df, expectations).write.mode("overwrite").partitionBy(VERDICT, BROKEN).parquet(path)
    schema = df.schema.add(VERDICT, "string").add(BROKEN, "string")
    counts = spark.read.schema(schema).parquet(path).groupBy(BROKEN).count().collect()  # combinations that occur
    return {r[BROKEN]: r["count"] for r in counts}


def _by_verdict(reader, path: str, schema: T.StructType, verdict: str) -> DataFrame:
    marks = [T.StructField(VERDICT, T.StringType()), T.StructField(BROKEN, T.StringType())]
    return reader.schema(T.StructType([*schema.fields, *marks])).parquet(path).filter(F.col(VERDICT) == verdict)


def read_kept(reader, path: str, schema: T.StructType) -> DataFrame:
    """The kept rows of :func:`write_judged`, with ``spark.read`` or ``spark.readStream``. Folders above the verdict do not matter."""
    return _by_verdict(reader, path, schema, KEPT).select(*[F.col(f"`{n}`") for n in schema.names])


def read_rejected(reader, path: str, schema: T.StructType) -> DataFrame:
    """The rejected rows, with ``broken``, the names of the rules they break."""
    return _by_verdict(reader, path, schema, REJECTED).select(*[F.col(f"`{n}`") for n in schema.names], F.split(BROKEN, ",").alias("broken"))


def write_expected(df: DataFrame, expectations: list[Expectation], path: str, dataset: str) -> DataFrame:
    """Write the rows that go on; return the counts. Nothing is left behind if a rule fails."""
    seen = Observation()
    kept = keep_expected(observed(df, expectations, seen), [e for e in expectations if e.on_violation == DROP])
    kept.write.mode("errorifexists").parquet(path)
    found = seen.get
    failed = {e.name: found[e.name] for e in expectations if e.on_violation == FAIL and found[e.name]}
    if failed:
        storage.delete(df.sparkSession, path)
        raise ExpectationFailed(f"{dataset}: {failed}")
    rows = [(dataset, e.name, found["records"] - found[e.name], found[e.name]) for e in expectations]
    return df.sparkSession.createDataFrame(rows, "dataset string, name string, passed_records long, failed_records long")


def split_valid(df: DataFrame, rule: Column | str) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the rule, and the others (NULL included)."""
    holds = Expectation("valid", rule).holds()
    return df.filter(holds), df.filter(~holds)


# ---- reports over a table of metrics or events ----------------------------------------------


def metrics_report(metrics: DataFrame) -> DataFrame:
    """Passing and failing records per dataset and expectation over any number of runs."""
    return metrics.groupBy("dataset", F.col("name").alias("expectation")).agg(
        F.sum("passed_records").alias("passing_records"), F.sum("failed_records").alias("failing_records")
    )


# The paths and fields of the log's JSON.
EXPECTATIONS_SCHEMA = "array<struct<name: string, dataset: string, passed_records: bigint, failed_records: bigint>>"


def latest_update(events: DataFrame, id_column: str = "origin.update_id") -> DataFrame:
    """One row: the id of the newest created update."""
    return (
        events.filter(F.col("event_type") == "create_update").orderBy(F.desc("timestamp")).limit(1)
        .select(F.col(id_column).alias("update_id"))
    )


def of_latest_update(events: DataFrame) -> DataFrame:
    """The events of the newest update."""
    newest = latest_update(events)  # one row
    return events.join(F.broadcast(newest), F.col("origin.update_id") == F.col("update_id"), "left_semi")


def user_actions(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "user_action").select(
        "timestamp",
        F.get_json_object("details", "$.user_action.action").alias("action"),
        F.get_json_object("details", "$.user_action.user_name").alias("user_name"),
    )


def lineage(events: DataFrame) -> DataFrame:
    """Output dataset of each flow and, as JSON text, the datasets it reads."""
    return events.filter(F.col("event_type") == "flow_definition").select(
        F.get_json_object("details", "$.flow_definition.output_dataset").alias("output_dataset"),
        F.get_json_object("details", "$.flow_definition.input_datasets").alias("input_datasets"),
    )


def expectation_events(events: DataFrame) -> DataFrame:
    """The per-run expectation counts inside flow-progress events, one row each."""
    text = F.get_json_object("details", "$.flow_progress.data_quality.expectations")
    return (
        events.filter(F.col("event_type") == "flow_progress")
        .select(F.explode(F.from_json(text, EXPECTATIONS_SCHEMA)).alias("e")).select("e.*")
    )


def over_threshold(df: DataFrame, column: str, limit: float) -> DataFrame:
    """Rows for which an alert would be due."""
    return df.filter(F.col(column) > limit)
