"""Audited, incremental table loads with schema versions.

Each table has a folder per schema version (v_001, v_002, ...); a load that brings a new column
starts the next one. Every load adds a row to the audit log.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import storage
from millrace.operators import merge as M
from millrace.operators.cleaning import latest_per_key
from millrace.operators.snapshots import SnapshotTable

# The columns of the audit log.
AUDIT_SCHEMA = (
    "table_name string, path string, load_date timestamp, write_mode string, load_type string, "
    "schema_version string, user string, latest_version long, base_version long"
)
FIRST_SCHEMA_VERSION = "v_001"  # fixed value


@dataclass(frozen=True)
class SchemaDifference:
    """``valid``: the extract brings no new column. Columns on one side only, and changed types."""

    valid: bool
    columns: frozenset[str]
    new: tuple[str, ...]
    dropped: tuple[str, ...]
    retyped: tuple[str, ...]


def compare_schemas(table: DataFrame, extract: DataFrame, check_types: bool = False) -> SchemaDifference:
    old, new = dict(table.dtypes), dict(extract.dtypes)
    added = tuple(c for c in new if c not in old)
    dropped = tuple(c for c in old if c not in new)
    retyped = tuple(c for c in new if c in old and new[c] != old[c])
    valid = not added and not (check_types and retyped)
    return SchemaDifference(valid, frozenset(added + dropped), added, dropped, retyped)


def next_schema_version(version: str) -> str:
    return f"v_{int(version.split('_')[-1]) + 1:03d}"


def schema_number() -> Column:
    """Schema versions by number: v_1000 comes after v_999."""
    return F.regexp_extract("schema_version", r"(\d+)$", 1).cast("long")


class LoadArea:
    """A folder of loaded tables with one audit log.

    Every ``EXPIRE_EVERY`` versions of a table, files that only versions older than ``retain`` name are removed;
    None keeps all.
    """

    EXPIRE_EVERY = 10

    def __init__(self, spark: SparkSession, root: str, user: str = "?", retain: timedelta | None = timedelta(days=7)):
        self.spark, self.root, self.user, self.retain = spark, root.rstrip("/"), user, retain
        self.audit = SnapshotTable(spark, f"{self.root}/audit_log")

    def table(self, name: str, schema_version: str | None = None) -> SnapshotTable:
        return SnapshotTable(self.spark, self.path(name, schema_version or self.last_schema_version(name)))

    def path(self, name: str, schema_version: str) -> str:
        return f"{self.root}/{name}/{schema_version}"

    # ---- audit log -----------------------------------------------------------------------

    def log(self, name: str, mode: str, load_type: str, load_date: datetime, schema_version: str) -> None:
        table = self.table(name, schema_version)
        row = (
            name, table.root, load_date, mode, load_type, schema_version, self.user,
            table.version(), table.previous_version(),
        )
        fields = T.DataType.fromDDL(AUDIT_SCHEMA).fields
        df = self.spark.range(0, 1, 1, 1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
        if not self.audit.exists():
            self.audit.create(df)
        else:
            self.audit.append(df)
            if self.audit.version() % 100 == 0:
                self.audit.compact(files=1)

    def audit_rows(self) -> DataFrame:
        return self.audit.read() if self.audit.exists() else self.spark.createDataFrame([], AUDIT_SCHEMA)

    def latest_loads(self, names: list[str] | None = None) -> DataFrame:
        """The newest audit row of each table, all tables in one aggregation."""
        rows = self.audit_rows()
        if names is not None:
            rows = rows.filter(F.col("table_name").isin(names))
        rows = rows.withColumn("__number", schema_number())
        return latest_per_key(rows, ["table_name"], ["load_date", "__number", "latest_version"]).drop("__number")

    def _latest(self, name: str) -> Row | None:
        rows = self.latest_loads([name]).collect()
        return rows[0] if rows else None

    def last_load_date(self, name: str) -> datetime | None:
        row = self._latest(name)
        return row["load_date"] if row else None

    def last_schema_version(self, name: str) -> str:
        newest = F.max_by("schema_version", schema_number())
        row = self.audit_rows().filter(F.col("table_name") == name).agg(newest.alias("v")).collect()[0]
        return row["v"] or FIRST_SCHEMA_VERSION

    def delete_audit_rows(self, path: str, load_date: datetime) -> int:
        return self.audit.delete((F.col("path") == path) & (F.col("load_date") == F.lit(load_date)))

    # ---- writing -------------------------------------------------------------------------

    def write(
        self, df: DataFrame, name: str, mode: str, load_type: str, load_date: datetime, primary_keys: str | list[str] | None = None
    ) -> str:
        """Load an extract by overwrite, append or merge; returns the schema version written."""
        if mode not in ("overwrite", "append", "merge"):
            raise ValueError(f"unknown write mode {mode}")
        if mode != "overwrite" and primary_keys is None:
            raise ValueError("append and merge need primary_keys")
        version = self.last_schema_version(name)
        table = self.table(name, version)
        if not table.exists():
            if mode != "overwrite":
                raise ValueError(f"{name} does not exist yet; load it with overwrite first")
            table.create(df)
        else:
            held = table.read()
            difference = compare_schemas(held, df)
            if mode == "overwrite":
                if difference.new or difference.retyped:
                    version = next_schema_version(version)
                    self.table(name, version).create(df)
                else:
                    table.overwrite(df, allow_missing=True)
            elif not difference.valid:
                version = self._merge_into_next_version(df, name, version, primary_keys)
            elif mode == "append":
                table.append(df, allow_missing=True)
            else:
                values = M.column_map(held.columns, df.columns)
                clauses = [M.when_matched_update(set=values), M.when_not_matched_insert(values=values)]
                table.merge(df, primary_keys, clauses, null_safe=True)
        self.log(name, mode, load_type, load_date, version)
        written = self.table(name, version)
        if self.retain is not None and written.version() % self.EXPIRE_EVERY == self.EXPIRE_EVERY - 1:
            written.expire(keep_versions=2, retain=self.retain, dry_run=False, force=True)
        return version

    def _merge_into_next_version(self, df: DataFrame, name: str, version: str, primary_keys: str | list[str]) -> str:
        """Old rows and the extract, merged by key, written once under the next schema version."""
        keys = M.split_keys(primary_keys)
        old = self.table(name, version).read()
        wide = old.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields if f.name not in old.columns])
        bumped = next_schema_version(version)
        target = self.table(name, bumped)
        extract = target._staged(df, f"{target.root}/staging/extract")
        try:
            M.check_single_match(old, extract, keys, null_safe=True)
            clauses = [M.when_matched_update(), M.when_not_matched_insert()]
            target.create(M.merge_rows(wide, extract, keys, clauses, null_safe=True))
        finally:
            storage.delete(self.spark, f"{target.root}/staging")
        return bumped

    # ---- reading state -------------------------------------------------------------------

    def high_watermark(self, name: str, column: str, pattern: str = "yyyy-MM-dd HH:mm:ss"):
        """Newest extraction time in a table, or None if there is no such table."""
        table = self.table(name)
        return high_watermark(table.read(), column, pattern).collect()[0][0] if table.exists() else None

    def rollback(self, name: str, load_type: str, load_date: datetime, mode: str = "overwrite") -> int | None:
        """Go back to the version before the newest one; None if there is none.

        Where the newest load began a schema version, that is the schema version before: the audit rows of
        the new one go, so that the next load starts it again.
        """
        schema = self.last_schema_version(name)
        table = self.table(name, schema)
        previous = table.previous_version()
        if previous is not None:
            restored = table.restore(previous)
            self.log(name, mode, load_type, load_date, schema)
            return restored
        loads = self.audit_rows().filter(F.col("table_name") == name).withColumn("__number", schema_number())
        current = int(schema.rpartition("_")[2])
        earlier = loads.filter(F.col("__number") < current).agg(F.max_by("schema_version", "__number").alias("v")).first()["v"]
        if earlier is None:
            return None
        self.audit.delete((F.col("table_name") == name) & (F.col("schema_version") == schema))
        self.log(name, mode, load_type, load_date, earlier)
        return self.table(name, earlier).version()

    def quality_gate(self, sources: dict[str, str], target: str, load_date: datetime) -> int:
        """After a load: -1 no source was ever loaded, 1 the target was empty and is rolled back, 2 it was empty and there is
        nothing to go back to, else 0.

        The target is looked at only if a source's newest load has the type given for it.
        """
        loads = self.latest_loads(list(sources)).select("table_name", "load_type").collect()
        if not loads:
            return -1
        if not any(sources[r["table_name"]] == r["load_type"] for r in loads):
            return 0
        if not self.table(target).read().isEmpty():
            return 0
        return 2 if self.rollback(target, next(iter(sources.values())), load_date) is None else 1


def high_watermark(df: DataFrame, column: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """One row: the newest time in a text column; texts that are no time are left out."""
    return df.agg(F.max(F.try_to_timestamp(F.col(column), F.lit(pattern))).alias("high_watermark"))


# ---- exports ------------------------------------------------------------------------------------
# The columns of both export logs.


def export_errors(failed: DataFrame, table_name: str, path: str, run_id: str, row_id: str, message: str, export_type: str, user: str = "?") -> DataFrame:
    """One error row per failed row, with the row itself as JSON payload."""
    columns = failed.columns
    return failed.select(
        F.lit(table_name).alias("table_name"), F.lit(path).alias("path"), F.lit(run_id).alias("pipeline_run_id"),
        F.current_timestamp().alias("timestamp"), F.col(row_id).cast("string").alias("row_id"),
        F.to_json(F.struct(*columns)).alias("payload"), F.expr(message).cast("string").alias("error_msg"),
        F.lit(export_type).alias("export_type"), F.lit(user).alias("user"),
    )


def export_audit(attempted: DataFrame, succeeded: str, table_name: str, path: str, run_id: str, export_type: str, latest_date: str, user: str = "?") -> DataFrame:
    """One row with the numbers of rows that did and did not go out, counted in one pass."""
    ok = F.coalesce(F.expr(succeeded), F.lit(False))
    return attempted.agg(
        F.count_if(ok).alias("successful_transfers"), F.count_if(~ok).alias("failed_transfers"),
        F.max(F.expr(latest_date)).alias("latest_date"),
    ).select(
        F.lit(table_name).alias("table_name"), F.lit(path).alias("path"), F.current_timestamp().alias("export_date"),
        F.lit(export_type).alias("export_type"), "successful_transfers", "failed_transfers",
        F.lit(run_id).alias("pipeline_run_id"), "latest_date", F.lit(user).alias("user"),
    )
