"""Files that keep arriving: schema, provenance and rescue of what does not fit."""

from __future__ import annotations

import csv
import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import storage
from millrace.operators.snapshots import SnapshotTable, widened
from millrace.sources.loader import infer_json_schema

RESCUED = "_rescued_data"


def infer_schema(
    spark: SparkSession, path: str | list[str], file_type: str = "json", infer_types: bool = False,
    hints: dict[str, str] | None = None, options: dict[str, str] | None = None,
) -> T.StructType:
    """Columns of the files there now. All are strings unless types are inferred; hints win."""
    if file_type == "json":
        found = T.DataType.fromDDL(infer_json_schema(spark.read.text(path), "value"))
    elif file_type == "csv":
        reader = spark.read.options(**{"header": "true", **(options or {})}).option("inferSchema", str(infer_types).lower())
        found = reader.csv(path).schema
    else:
        raise ValueError(f"ingestion reads json or csv, not {file_type}")
    hints = hints or {}
    fields = [
        T.StructField(f.name, T.DataType.fromDDL(hints[f.name]) if f.name in hints
                      else (f.dataType if infer_types else T.StringType()))
        for f in found.fields
    ]
    known = {f.name for f in fields}
    fields += [T.StructField(n, T.DataType.fromDDL(t)) for n, t in hints.items() if n not in known]
    return T.StructType(fields)


def _entry_of(path: Column, raw: Column) -> Column:
    """One (path, value): a text as it is, anything else as JSON."""
    return F.struct(path.alias("path"), F.try_variant_get(raw, "$", "string").alias("value"))


def _misfits(value: Column, raw: Column, kind: T.DataType, path: Column, top: bool = False) -> Column:
    """What of ``raw``, a variant, did not make it into ``value``, which was parsed as ``kind``: (path, value) pairs."""
    none = F.array().cast("array<struct<path: string, value: string>>")
    there = raw.isNotNull() & ~F.coalesce(F.is_variant_null(raw), F.lit(False))
    whole = F.when(there & value.isNull(), F.array(_entry_of(path, raw))).otherwise(none)
    if isinstance(kind, T.StructType):
        fields = F.try_variant_get(raw, "$", "map<string,variant>")
        at = lambda name: name if top else F.concat(path, F.lit("."), name)
        unknown = F.map_filter(fields, lambda k, v: ~k.isin(*kind.names) & ~F.coalesce(F.is_variant_null(v), F.lit(False)))
        extra = F.transform(F.map_entries(unknown), lambda e: _entry_of(at(e["key"]), e["value"]))
        inside = [_misfits(value[f.name], fields[f.name], f.dataType, at(F.lit(f.name))) for f in kind.fields]
        found = F.concat(F.coalesce(extra, none), *inside)
        return F.when(fields.isNull() | value.isNull(), whole).otherwise(found)
    if isinstance(kind, T.ArrayType):
        elements = F.try_variant_get(raw, "$", "array<variant>")
        each = F.transform(elements, lambda x, i: _misfits(F.get(value, i), x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        return F.when(elements.isNull() | value.isNull(), whole).otherwise(F.flatten(each))
    return whole


def parse_lines(lines: DataFrame, schema: T.StructType, keep: list[Column] | None = None) -> DataFrame:
    """JSON lines to columns, plus what did not fit.

    Each line is parsed to the schema and, as it is, to a variant; the two trees are compared. ``_rescued_data``
    is JSON text of the values that have no field or another type, by their dotted path (``items[2].price``),
    numbers, arrays and objects as JSON text; for a line that is no JSON object it is the line itself; else NULL.
    Fields that hold null are no loss.
    """
    parsed = lines.select(
        "value", F.from_json("value", schema).alias("r"), F.try_parse_json("value").alias("m"), *(keep or [])
    )
    extra = _misfits(F.col("r"), F.col("m"), schema, F.lit(""), top=True)
    kept = [c for c in parsed.columns if c not in ("value", "r", "m")]
    rows = parsed.withColumn("x", extra)
    no_object = F.try_variant_get(F.col("m"), "$", "map<string,variant>").isNull()
    rescued = F.when(no_object, F.col("value")).when(F.size("x") > 0, F.to_json(F.map_from_entries("x")))
    return rows.select("r.*", rescued.alias(RESCUED), *kept)


def header_groups(spark: SparkSession, paths: list[str], options: dict[str, str] | None = None) -> dict[tuple[str, ...], list[str]]:
    """CSV files by the names in their first line."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        line = storage.first_line(spark, path)
        names = next(csv.reader([line], delimiter=(options or {}).get("sep", ","))) if line else []
        groups.setdefault(tuple(names), []).append(path)
    return groups


def read_csv(spark: SparkSession, paths: list[str], schema: T.StructType, options: dict[str, str] | None = None) -> DataFrame:
    """CSV files by the names in each file's own header, whatever the order, plus what did not fit.

    A column that a file lacks is NULL. ``_rescued_data`` is JSON text of values without a column in the
    schema or of another type, by their column; a line with more or fewer values than its header is kept
    there as it is, beside what could be read. Files of one header are read together.
    """
    frames = []
    for names, files in header_groups(spark, paths, options).items():
        texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))] + [T.StructField("__line", T.StringType())])
        reader = spark.read.options(**(options or {})).option("header", True).option("columnNameOfCorruptRecord", "__line").schema(texts)
        # The header is only skipped: its names are known, and may be any.
        rows = reader.option("enforceSchema", True).csv(files)
        place = {n: F.col(f"c{i}") for i, n in reversed(list(enumerate(names)))}
        typed, unfit = [], []
        for f in schema.fields:
            raw = place.get(f.name, F.lit(None).cast("string"))
            typed.append(raw.try_cast(f.dataType).alias(f.name))
            unfit.append(F.struct(F.lit(f.name).alias("path"), F.when(raw.try_cast(f.dataType).isNull(), raw).alias("value")))
        unfit += [F.struct(F.lit(n).alias("path"), c.alias("value")) for n, c in place.items() if n not in schema.names]
        extra = F.filter(F.array(*unfit), lambda e: e["value"].isNotNull()) if unfit else F.array()
        rescued = F.when(F.col("__line").isNotNull(), F.col("__line")).when(F.size(extra) > 0, F.to_json(F.map_from_entries(extra)))
        frames.append(rows.select(*typed, rescued.alias(RESCUED), *_provenance()))
    if not frames:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])).select("*", F.current_timestamp().alias("processing_time"), F.lit(None).cast("string").alias("source_file"))
    return reduce(DataFrame.unionByName, frames)


class FileFeed:
    """Files of a folder, each loaded once, with a schema that grows with them.

    The schema is a log of numbered files, beginning with ``schema`` or what the first files hold. Each
    micro-batch is looked through for fields that the newest entry lacks, at any depth; they become
    nullable columns of a new entry before the batch is parsed, so that no value has to be rescued but those of
    another type. Without ``infer_types`` new top-level columns are strings.
    """

    def __init__(
        self, spark: SparkSession, path: str, log: str, file_type: str = "json", schema: T.StructType | None = None, infer_types: bool = True,
        files_per_batch: int = 1000, options: dict[str, str] | None = None,
    ):
        if file_type not in ("json", "csv"):
            raise ValueError(f"ingestion reads json or csv, not {file_type}")
        self.spark, self.path, self.log, self.file_type = spark, path, log.rstrip("/"), file_type
        self.infer_types, self.files_per_batch, self.options = infer_types, files_per_batch, dict(options or {})
        if schema is not None and not storage.exists(spark, self.log):
            self._add(0, schema)

    def _add(self, number: int, schema: T.StructType) -> None:
        storage.create_text(self.spark, f"{self.log}/{number:09d}.json", schema.json())

    def schemas(self) -> list[T.StructType]:
        """All entries of the log, oldest first."""
        if not storage.exists(self.spark, self.log):
            return []
        names = sorted(n for n in storage.file_names(self.spark, self.log) if n.endswith(".json") and not n.startswith("."))
        return [T.StructType.fromJson(json.loads(storage.read_text(self.spark, f"{self.log}/{n}"))) for n in names]

    def schema(self) -> T.StructType | None:
        found = self.schemas()
        return found[-1] if found else None

    def _grown(self, paths: list[str]) -> T.StructType:
        known = self.schemas()
        groups = header_groups(self.spark, paths, self.options).values() if self.file_type == "csv" else [paths]
        schema = known[-1] if known else T.StructType([])
        for files in groups:
            schema = widened(schema, infer_schema(self.spark, files, self.file_type, self.infer_types, options=self.options))
        if not known or schema != known[-1]:
            self._add(len(known), schema)
        return schema

    def rows(self, paths: list[str]) -> DataFrame:
        """The rows of some files, after their new fields have gone into the log."""
        schema = self._grown(paths)
        if self.file_type == "csv":
            return read_csv(self.spark, paths, schema, self.options)
        lines = self.spark.read.options(**self.options).text(paths).select("value", *_provenance())
        return parse_lines(lines, schema, [F.col("processing_time"), F.col("source_file")])

    def run(self, add: Callable[[DataFrame, str], None], checkpoint: str) -> None:
        """Call ``add(rows, tag)`` for all files there are now and were not before. The tag tells a batch that comes again."""

        def batch(names: DataFrame, number: int) -> None:
            paths = sorted(r[0] for r in names.collect())  # files_per_batch at most
            if paths:
                add(self.rows(paths), f"{checkpoint}:{number}")

        names = "path string, modificationTime timestamp, length long, content binary"  # the format's own; only the path is read
        files = self.spark.readStream.schema(names).format("binaryFile").option("maxFilesPerTrigger", self.files_per_batch).load(self.path).select("path")
        files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start().awaitTermination()

    def load_into(self, table: SnapshotTable, checkpoint: str) -> None:
        """Append new files to a versioned table, which gets the new columns too."""

        def add(rows: DataFrame, tag: str) -> None:
            if table.exists():
                table.append(rows, tag=tag, evolve=True)
            else:
                table.create(rows, tag=tag)

        self.run(add, checkpoint)


def _provenance() -> list[Column]:
    return [F.current_timestamp().alias("processing_time"), F.col("_metadata.file_path").alias("source_file")]


def ingest(
    spark: SparkSession, path: str, schema: T.StructType, file_type: str = "json", stream: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A stream (or a batch) of the files' rows with load time, source file and rescued data.

    CSV columns are taken by place; :class:`FileFeed` takes them by each file's header, and lets the schema grow.
    """
    reader = (spark.readStream if stream else spark.read).options(**(options or {}))
    if file_type == "json":
        return parse_lines(reader.text(path).select("value", *_provenance()), schema, [F.col("processing_time"), F.col("source_file")])
    if file_type == "csv":
        wide = T.StructType(schema.fields + [T.StructField(RESCUED, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", RESCUED)
        if "header" not in (options or {}):
            reader = reader.option("header", "true")
        return reader.schema(wide).csv(path).select("*", *_provenance())
    raise ValueError(f"ingestion reads json or csv, not {file_type}")
