"""Versioned tables: Parquet parts plus one history row per version.

A part is a Parquet file that is written once and never changed. A version is a list of parts.
A change writes the rows it makes, then adds a history row naming the parts that are still
valid and the new ones. So appending and restoring move no old data, and update, delete and
merge rewrite only those files that hold a row they touch. A table with an index over its
merge key (:mod:`millrace.operators.keyindex`) does not read the other files at all. The history
has one JSON file per version; the newest one is the only thing the driver reads.

Every attempt writes into folders of its own. Of two writers of one version the store lets one
create the history row; the other is refused and removes its own folder. A writer that dies
before its history row leaves a folder that no version names.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import Counter
from datetime import datetime, timedelta, timezone
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import storage
from millrace.operators import curve, keyindex
from millrace.operators import merge as M

HISTORY_SCHEMA = (
    "version long, committed_at timestamp, operation string, rows_added long, rows_removed long, row_count long, "
    "parts array<struct<root: string, path: string, uri: string, rows: long, files: long>>, partition_by array<string>, schema string, "
    "constraints map<string,string>, generated map<string,string>, comment string, tag string, tags map<string,long>, index_by array<string>"
)

# Rows of one sort when a compaction puts many into a file, and the most sorts of one compaction.
SORT_ROWS, MOST_SORTS = 1_000_000, 256

# Spark reads this folder level as a column, so no table may have a column of this name.
VERSION_FOLDER = "millrace_version"


def folder_of(part) -> str:
    """The folder that holds a part's file, below the table's data."""
    return part["path"].rpartition("/")[0]


def _without_scheme(file: str) -> str:
    """A file's URL-encoded path without scheme and host."""
    return re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", file)


def partition_of(part) -> str:
    """The partition values of a part, as they stand in its path."""
    return folder_of(part).partition("/")[2]


def widened(old: T.DataType, new: T.DataType) -> T.DataType:
    """The old type with the fields that only the new one has, at any depth; other differences stay as they are."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        fresh = {f.name: f.dataType for f in new.fields}
        fields = [T.StructField(f.name, widened(f.dataType, fresh[f.name]) if f.name in fresh else f.dataType, f.nullable) for f in old.fields]
        return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name not in old.names])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened(old.elementType, new.elementType), True)
    return old


def _writer(tag: str) -> tuple[str, int]:
    """'name:7' to its writer and number; another tag is a writer of its own."""
    name, _, number = tag.rpartition(":")
    return (name, int(number)) if name and number.isdigit() else (tag, 0)


class SchemaMismatch(ValueError):
    pass


class ConstraintViolated(ValueError):
    pass


def with_generated(df: DataFrame, generated: dict[str, str]) -> DataFrame:
    """Fill generated columns from their rule; a supplied value has to equal the rule's."""
    for name, rule in generated.items():
        if name in df.columns:
            wrong = ~F.col(name).eqNullSafe(F.expr(rule))
            message = F.concat(F.lit(f"generated column {name} must equal {rule}, got "), F.col(name).cast("string"))
            checked = F.when(wrong, F.raise_error(message).cast(df.schema[name].dataType)).otherwise(F.col(name))
            df = df.withColumn(name, checked)
        else:
            df = df.withColumn(name, F.expr(rule))
    return df


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---- history -------------------------------------------------------------------------

    def exists(self) -> bool:
        return storage.exists(self.spark, f"{self.root}/history")

    def _log(self) -> DataFrame:
        return self.spark.read.schema(HISTORY_SCHEMA).json(f"{self.root}/history")

    def history(self) -> DataFrame:
        """Version, time, operation and row counts of each change."""
        return self._log().select("version", "committed_at", "operation", "rows_added", "rows_removed", "row_count", "comment")

    def _versions(self) -> list[int]:
        names = storage.file_names(self.spark, f"{self.root}/history")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _history_file(self, version: int) -> str:
        return f"{self.root}/history/{version:020d}.json"

    def _entry(self, version: int | None = None, as_of: datetime | None = None) -> dict:
        if as_of is not None:
            version = self._log().filter(F.col("committed_at") <= F.lit(as_of)).agg(F.max("version")).first()[0]
        elif version is None and self.exists():
            version = max(self._versions(), default=None)
        if version is None or not storage.exists(self.spark, self._history_file(version)):
            raise ValueError(f"{self.root} has no version {version if as_of is None else as_of}")
        return json.loads(storage.read_text(self.spark, self._history_file(version)))

    def version(self) -> int:
        return max(self._versions())

    def previous_version(self) -> int | None:
        versions = self._versions()
        return versions[-2] if len(versions) > 1 else None

    def has_tag(self, tag: str) -> bool:
        """Whether this tag, or a later number of its writer, is committed. The newest entry holds each writer's last."""
        if not self.exists():
            return False
        writer, number = _writer(tag)
        return (self._entry().get("tags") or {}).get(writer, -1) >= number

    # ---- reading -------------------------------------------------------------------------

    def _read_parts(self, parts, schema: T.StructType, with_part: bool = False) -> DataFrame:
        extra = [F.lit(None).cast("string").alias("__part")] if with_part else []
        if not parts:
            return self.spark.createDataFrame([], schema).select("*", *extra)
        frames = []
        for root, paths in self._paths(parts).items():
            df = self.spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*[f"{root}/data/{p}" for p in paths])
            if with_part:
                extra = [F.col("_metadata.file_path").alias("__part")]
            frames.append(df.select(*[F.col(f"`{n}`") for n in schema.names], *extra))
        return reduce(DataFrame.unionByName, frames)

    @staticmethod
    def _paths(parts) -> dict[str, list[str]]:
        """Paths to read by root: a folder of which all files are wanted is one path."""
        folders: dict[tuple[str, str], list] = {}
        for part in parts:
            folders.setdefault((part["root"], folder_of(part)), []).append(part)
        out: dict[str, list[str]] = {}
        for (root, folder), members in folders.items():
            whole = len(members) == members[0]["files"]
            out.setdefault(root, []).extend([folder] if whole else [p["path"] for p in members])
        return out

    def _among(self, parts: list[dict], files) -> tuple[list[dict], list[dict]]:
        """Parts that are, and are not, among files named as in ``_metadata.file_path``."""
        inside = {_without_scheme(f) for f in files}
        roots = {root: storage.raw_path(self.spark, f"{root}/data") for root in {p["root"] for p in parts}}
        met = [f"{roots[p['root']]}/{p['uri']}" in inside for p in parts]
        return [p for p, m in zip(parts, met) if m], [p for p, m in zip(parts, met) if not m]

    @staticmethod
    def _part_label(part) -> str:
        return f"{part['root']}|{part['uri']}"

    def read(self, version: int | None = None, as_of: datetime | None = None) -> DataFrame:
        """The table now, at a version, or at a time."""
        entry = self._entry(version, as_of)
        return self._read_parts(entry["parts"], T.StructType.fromJson(json.loads(entry["schema"])))

    # ---- writing -------------------------------------------------------------------------

    def _checked(self, df: DataFrame, constraints: dict[str, str]) -> tuple[DataFrame, Observation | None]:
        """Count violations of each constraint in the same pass that writes the rows."""
        if not constraints:
            return df, None
        seen = Observation()
        # A NULL predicate passes, as in CHECK.
        counts = [F.count_if(~F.expr(p)).alias(name) for name, p in constraints.items()]
        return df.observe(seen, *counts), seen

    def _commit(
        self, operation: str, rows: DataFrame | None, keep: list, schema: T.StructType, *, previous=None,
        partition_by: list[str] | None = None, constraints=None, generated=None, comment=None, tag=None,
        replace_partitions: bool = False, index_by: list[str] | None = None, gather: bool = True,
    ) -> int:
        if VERSION_FOLDER in (n.lower() for n in schema.names):
            raise SchemaMismatch(f"a column may not be called {VERSION_FOLDER}")
        version = previous["version"] + 1 if previous else 0
        partition_by = list(partition_by or [])
        constraints, generated = dict(constraints or {}), dict(generated or {})
        new_parts = []
        if rows is not None:
            # A folder of this attempt's own: a writer that loses the race touches no committed file.
            folder = f"{VERSION_FOLDER}={version}-{uuid.uuid4().hex[:12]}"
            target = f"{self.root}/data/{folder}"
            rows, seen = self._checked(rows.select(*[F.col(f"`{n}`") for n in schema.names]), constraints)
            if partition_by and gather:
                # Gather each partition in few files; one too large for a task is split.
                rows = rows.hint("rebalance", *partition_by)
            rows.write.partitionBy(*partition_by).parquet(target)
            if seen is not None:
                broken = {k: v for k, v in seen.get.items() if v}
                if broken:
                    storage.delete(self.spark, target)
                    raise ConstraintViolated(f"{operation} on {self.root} violates {broken}")
            rows_of = self._rows_of_files(folder, schema)
            new_parts = self._parts_of_files(rows_of)
            if not new_parts:
                storage.delete(self.spark, target)
            if index_by and new_parts:
                written = self._read_parts(new_parts, schema, True).select(*index_by, "__part")
                keyindex.write(written, index_by, rows_of, f"{self.root}/index/{folder}")
        if replace_partitions:
            written = {partition_of(p) for p in new_parts}
            keep = [p for p in keep if partition_of(p) not in written]
        parts = [*keep, *new_parts]
        before = sum(p["rows"] for p in previous["parts"]) if previous else 0
        kept = sum(p["rows"] for p in keep)
        after = sum(p["rows"] for p in parts)
        tags = dict((previous or {}).get("tags") or {})
        if tag is not None:
            writer, number = _writer(tag)
            tags[writer] = max(number, tags.get(writer, -1))
        entry = {
            "version": version, "committed_at": datetime.now(timezone.utc).isoformat(), "operation": operation,
            "rows_added": after - kept, "rows_removed": max(before - kept, 0), "row_count": after, "parts": parts,
            "partition_by": partition_by, "schema": schema.json(), "constraints": constraints, "generated": generated,
            "comment": comment, "tag": tag, "tags": tags, "index_by": list(index_by or []),
        }
        try:
            storage.create_text(self.spark, self._history_file(version), json.dumps(entry))
        except FileExistsError:
            if rows is not None:
                storage.delete(self.spark, target)
            raise
        return version

    def _rows_of_files(self, folder: str, schema: T.StructType) -> dict[str, int]:
        """The files that were written, with their rows. Counts come from footers: exact even if tasks were retried."""
        found = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(f"{self.root}/data/{folder}")
        return {r["file"]: r["count"] for r in found.groupBy(F.col("_metadata.file_path").alias("file")).count().collect()}

    def _parts_of_files(self, rows_of: dict[str, int]) -> list[dict]:
        start = len(storage.raw_path(self.spark, f"{self.root}/data")) + 1
        uris = {_without_scheme(f)[start:]: n for f, n in rows_of.items()}
        parts = [{"root": self.root, "path": unquote(uri), "uri": uri, "rows": n} for uri, n in sorted(uris.items())]
        siblings = Counter(folder_of(p) for p in parts)
        return [{**p, "files": siblings[folder_of(p)]} for p in parts]

    def _again(self, previous, operation: str, rows: DataFrame | None, keep: list, schema=None, tag=None, **options) -> int:
        """Commit with the table's own layout and rules."""
        return self._commit(
            operation, rows, keep, schema or T.StructType.fromJson(json.loads(previous["schema"])), previous=previous,
            partition_by=previous["partition_by"], constraints=previous["constraints"],
            generated=previous["generated"], comment=previous["comment"], tag=tag, index_by=previous.get("index_by"), **options,
        )

    def _fit(self, df: DataFrame, entry, allow_missing: bool = False) -> DataFrame:
        """Check a frame against the table's schema and put its columns in the table's order."""
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        df = with_generated(df, entry["generated"] or {})
        have = {f.name: f.dataType for f in df.schema.fields}
        unknown = [n for n in have if n not in schema.names]
        missing = [f.name for f in schema.fields if f.name not in have]
        other = [f.name for f in schema.fields if f.name in have and have[f.name] != f.dataType]
        if unknown or other or (missing and not allow_missing):
            raise SchemaMismatch(f"{self.root}: new columns {unknown}, missing {missing}, other type {other}")
        return df.select(*[
            F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields
        ])

    def create(
        self, df: DataFrame, partition_by: list[str] | None = None, constraints: dict[str, str] | None = None,
        generated: dict[str, str] | None = None, comment: str | None = None, tag: str | None = None, index_by: list[str] | None = None,
        gather: bool = True,
    ) -> int:
        """Create the table, or replace its contents, schema and rules.

        Rows of a partition are gathered in few files by a shuffle; without ``gather`` each task writes its own.

        ``index_by`` names the key of later merges: each file's smallest and largest key and a Bloom filter of its
        keys are kept beside the data, so that a merge reads only files that may hold a key of its source.
        """
        df = with_generated(df, generated or {})
        previous = self._entry() if self.exists() else None
        return self._commit(
            "CREATE OR REPLACE", df, [], df.schema, previous=previous, partition_by=partition_by,
            constraints=constraints, generated=generated, comment=comment, tag=tag, index_by=index_by, gather=gather,
        )

    def overwrite(self, df: DataFrame, allow_missing: bool = False, tag: str | None = None) -> int:
        """Replace all rows; the schema has to stay."""
        entry = self._entry()
        return self._again(entry, "OVERWRITE", self._fit(df, entry, allow_missing), [], tag=tag)

    def overwrite_partitions(self, df: DataFrame) -> int:
        """Replace only those partitions for which ``df`` has rows."""
        entry = self._entry()
        if not entry["partition_by"]:
            raise ValueError(f"{self.root} is not partitioned")
        return self._again(entry, "OVERWRITE PARTITIONS", self._fit(df, entry), entry["parts"], replace_partitions=True)

    def append(self, df: DataFrame, allow_missing: bool = False, tag: str | None = None, evolve: bool = False) -> int:
        """Add rows; none of the old files is read or moved. A tag is applied once only.

        ``evolve`` adds new columns, and new fields of structs, to the table's schema; old rows have NULL there.
        """
        entry = self._entry()
        if tag is not None and self.has_tag(tag):
            return entry["version"]
        if evolve:
            schema = widened(T.StructType.fromJson(json.loads(entry["schema"])), df.schema)
            entry, allow_missing = {**entry, "schema": schema.json()}, True
        return self._again(entry, "APPEND", self._fit(df, entry, allow_missing), entry["parts"], tag=tag)

    def _split(self, entry, touched: DataFrame) -> tuple[list, list]:
        """Parts with and without a row in ``touched`` (a frame with a ``__part`` column)."""
        return self._among(entry["parts"], [r["__part"] for r in touched.select("__part").distinct().collect()])

    def update(self, condition: Column | str, set: dict[str, Column | str]) -> int:
        entry = self._entry()
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        condition = F.expr(condition) if isinstance(condition, str) else condition
        hit, keep = self._split(entry, self._read_parts(entry["parts"], schema, True).filter(condition))
        rows = self._read_parts(hit, schema)
        values = {
            n: F.when(condition, (F.expr(v) if isinstance(v, str) else v).cast(schema[n].dataType)).otherwise(F.col(n))
            for n, v in set.items()
        }
        # One select, so that every new value is computed from the old row.
        rows = rows.select(*[values[n].alias(n) if n in values else F.col(n) for n in schema.names])
        return self._again(entry, "UPDATE", rows if hit else None, keep)

    def delete(self, condition: Column | str | None = None) -> int:
        """Remove rows for which the condition is true; a NULL condition keeps the row."""
        entry = self._entry()
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        if condition is None:
            return self._again(entry, "DELETE", None, [])
        condition = F.expr(condition) if isinstance(condition, str) else condition
        hit, keep = self._split(entry, self._read_parts(entry["parts"], schema, True).filter(condition))
        rows = self._read_parts(hit, schema).filter(~F.coalesce(condition, F.lit(False)))
        return self._again(entry, "DELETE", rows if hit else None, keep)

    def merge(
        self, source: DataFrame, keys: str | list[str], clauses: list[M.Clause], null_safe: bool = False,
        evolve: bool = False, tag: str | None = None,
    ) -> int:
        """Apply ordered clauses. ``evolve`` adds the source's new columns to the table.

        The source is written to the table's folder first: the several passes over it then
        see the same rows, even if it is random, time-dependent or costly. The target is read
        twice: its keys, to find the parts and keys the source mentions, and then those parts. With an
        index over the keys, only the parts that it cannot rule out are read for keys.
        """
        entry = self._entry()
        if tag is not None and self.has_tag(tag):
            return entry["version"]
        keys = M.split_keys(keys)
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        if evolve:
            new = [f for f in source.schema.fields if f.name not in schema.names]
            schema = T.StructType(schema.fields + [T.StructField(f.name, f.dataType, True) for f in new])
        staging = f"{self.root}/staging/{entry['version'] + 1}-{uuid.uuid4().hex[:12]}"
        staged = self._staged(source, f"{staging}/source")
        near = self._may_hold(entry, staged, keys, null_safe)
        staged = M.for_joins(staged)
        everything = self._read_parts(near, schema, True)
        known = self._staged(M.known_keys(everything, staged, keys, null_safe, also=["__part"]), f"{staging}/known")
        hit, keep, survivors = [], list(entry["parts"]), None
        if any(c.kind != M.INSERT for c in clauses):
            M.check_single_match(known, staged, keys, null_safe)
            hit, keep = self._split(entry, known)
        if hit:
            survivors = M.matched_rows(self._read_parts(hit, schema), staged, keys, clauses, null_safe)
        added = M.inserted_rows(known, staged, keys, clauses, schema, null_safe)
        frames = [f for f in (survivors, added) if f is not None]
        rows = reduce(DataFrame.unionByName, frames) if frames else None
        try:
            return self._again(entry, "MERGE", rows, keep, schema, tag=tag)
        finally:
            storage.delete(self.spark, staging)

    def _may_hold(self, entry, staged: DataFrame, keys: list[str], null_safe: bool = False) -> list[dict]:
        """The parts that may hold a key of the staged rows, as far as an index tells."""
        if not keys or list(entry.get("index_by") or []) != list(keys):
            return entry["parts"]
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        asked = staged.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in keys])
        folders = sorted({f"{p['root']}/index/{p['path'].partition('/')[0]}" for p in entry["parts"]})
        found = keyindex.candidates(self.spark, folders, asked, keys, len(entry["parts"]), null_safe)
        return self._among(entry["parts"], found)[0]

    def replace_parts(self, old: list[dict], rows: DataFrame | None, operation: str = "REWRITE", tag: str | None = None) -> int:
        """Put ``rows`` in the place of some parts of the newest version; the others stay as they are."""
        entry, gone = self._entry(), {self._part_label(p) for p in old}
        return self._again(entry, operation, rows, [p for p in entry["parts"] if self._part_label(p) not in gone], tag=tag)

    def parts(self, version: int | None = None) -> list[dict]:
        """Root, path and rows of each file of a version."""
        return self._entry(version)["parts"]

    def read_parts(self, parts: list[dict]) -> DataFrame:
        """The rows of some parts of the newest version's schema."""
        return self._read_parts(parts, T.StructType.fromJson(json.loads(self._entry()["schema"])))

    def _staged(self, df: DataFrame, path: str) -> DataFrame:
        """The frame's rows, written once next to the table so that every pass sees the same."""
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # ---- upkeep --------------------------------------------------------------------------

    def restore(self, version: int) -> int:
        """Make an old version the newest one. No data is copied; an expired version is refused."""
        old, entry = self._entry(version), self._entry()
        present = {self._part_label(p) for p in entry["parts"]}
        lost = [p for p in old["parts"] if self._part_label(p) not in present]
        if not all(storage.exists(self.spark, f"{p['root']}/data/{p['path']}") for p in lost):
            raise ValueError(f"version {version} of {self.root} has expired")
        return self._commit(
            f"RESTORE {version}", None, old["parts"], T.StructType.fromJson(json.loads(old["schema"])), previous=entry,
            partition_by=old["partition_by"], constraints=old["constraints"], generated=old["generated"], comment=old["comment"],
            index_by=old.get("index_by"),
        )

    def compact(self, cluster_by: list[str] | None = None, files: int | None = None, together: bool = False) -> int:
        """Rewrite into fewer files, optionally keeping rows with near keys together.

        Keys count in turn: a range of the first lies in few files. With ``together`` all keys count alike: rows
        follow a curve over the ranks of their keys, and a range of any key lies in few files. A row number
        breaks ties, so that a key with very many rows still spreads over files. Without keys and file
        count, adaptive execution sizes the files.

        A file of many rows is sorted in stretches of about ``SORT_ROWS`` rows, each by a task, and then written from
        them in their order. So a task's memory does not grow with the file.
        """
        entry = self._entry()
        df, staging, sorts = self.read(), None, 1
        if cluster_by:
            df = df.withColumn("__row", F.monotonically_increasing_id())
            keys = [F.col(k) for k in cluster_by]
            if together:
                df = df.withColumn("__along", curve.curve(self.read(), cluster_by, entry["row_count"]))
                keys = [F.col("__along")]
            order = [*keys, F.col("__row")]
            if files and not entry["partition_by"]:  # rows of a partitioned table are gathered anew
                sorts = max(1, min(-(-entry["row_count"] // (files * SORT_ROWS)), MOST_SORTS // files))
            df = df.repartitionByRange(files * sorts, *order) if files else df.repartitionByRange(*order)
            df = df.sortWithinPartitions(*keys).drop("__row", "__along")
            if sorts > 1:
                staging = f"{self.root}/staging/{entry['version'] + 1}-{uuid.uuid4().hex[:12]}"
                df = self._strung(df, files, staging)
        elif files:
            df = df.repartition(files)
        else:
            df = df.hint("rebalance")
        try:
            return self._again(entry, "OPTIMIZE", df, [])
        finally:
            if staging:
                storage.delete(self.spark, staging)

    def _strung(self, df: DataFrame, files: int, path: str) -> DataFrame:
        """The frame's partitions, written in ``path``, as ``files`` partitions that each read neighbouring ones in their order."""
        df.write.parquet(path)
        names = sorted(n for n in storage.file_names(self.spark, path) if n.startswith("part-"))
        read = self.spark.read.schema(df.schema)
        strung = []
        for i in range(files):
            some = [read.parquet(f"{path}/{n}") for n in names[len(names) * i // files : len(names) * (i + 1) // files]]
            if some:
                strung.append(reduce(DataFrame.union, some).coalesce(1))
        # A union of single partitions alone would be one partition; this reads no file.
        return reduce(DataFrame.union, strung, read.option("pathGlobFilter", "none").parquet(path))

    def repartition(self, files: int) -> int:
        entry = self._entry()
        return self._again(entry, "REPARTITION", self.read().repartition(files), [])

    def file_ranges(self, columns: list[str]) -> DataFrame:
        """Rows of each file of the newest version, and the smallest and largest value of some columns."""
        entry = self._entry()
        rows = self._read_parts(entry["parts"], T.StructType.fromJson(json.loads(entry["schema"])), True)
        limits = [f(c).alias(f"{n}_{c}") for c in columns for f, n in ((F.min, "low"), (F.max, "high"))]
        return rows.groupBy(F.col("__part").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *limits)

    def usage(self) -> DataFrame:
        """Files and bytes of the newest version, by the sizes in the file metadata."""
        entry = self._entry()
        counts = [storage.usage(self.spark, f"{root}/data/{path}") for root, paths in self._paths(entry["parts"]).items() for path in paths]
        return self.spark.createDataFrame(
            [(entry["version"], sum(c[0] for c in counts), sum(c[1] for c in counts))], "version long, files long, bytes long"
        )

    def expire(self, keep_versions: int = 1, retain: timedelta = timedelta(days=7), dry_run: bool = True, force: bool = False) -> DataFrame:
        """List, or remove, parts that no kept version needs.

        Kept are the newest ``keep_versions`` and all versions younger than ``retain``. Less
        than seven days needs ``force``, as a long-running reader may still use the files.
        """
        if retain < timedelta(days=7) and not force:
            raise ValueError("retention under 7 days may break running readers; pass force=True to do it anyway")
        if keep_versions < 1:
            raise ValueError("the newest version has to be kept")
        log = self._log()
        newest = self.version()
        young = F.col("committed_at") >= F.lit(datetime.now(timezone.utc) - retain)
        parts = log.select("version", (young | (F.col("version") > newest - keep_versions)).alias("kept"), F.explode("parts").alias("p"))
        files = parts.filter(F.col("p.root") == self.root).groupBy(F.col("p.path").alias("path")).agg(F.bool_or("kept").alias("kept"), F.max("version").alias("last_version"))
        folder = F.regexp_replace("path", "/[^/]*$", "")
        used = files.filter("kept").select(folder.alias("folder")).distinct().withColumn("in_use", F.lit(True))
        # A folder without a kept file goes as a whole.
        dead = (
            files.filter("NOT kept").withColumn("folder", folder).join(used, "folder", "left")
            .groupBy(F.when(F.col("in_use"), F.col("path")).otherwise(F.col("folder")).alias("part")).agg(F.max("last_version").alias("last_version"))
        )
        if dry_run:
            return dead
        gone = dead.collect()  # bounded by the number of parts ever written
        for row in gone:
            storage.delete(self.spark, f"{self.root}/data/{row['part']}")
        return self.spark.createDataFrame([(r["part"], r["last_version"]) for r in gone], "part string, last_version long")

    def clone(self, destination: str, deep: bool = True) -> SnapshotTable:
        """A new table with the same rows: copied files, or references to this table's files.

        A shallow clone is independent from then on, but breaks if this table expires parts.
        """
        entry = self._entry()
        other = SnapshotTable(self.spark, destination)
        previous = other._entry() if other.exists() else None
        other._commit(
            "CLONE", self.read() if deep else None, [] if deep else entry["parts"],
            T.StructType.fromJson(json.loads(entry["schema"])), previous=previous, partition_by=entry["partition_by"],
            constraints=entry["constraints"], generated=entry["generated"], comment=entry["comment"], index_by=entry.get("index_by"),
        )
        return other
