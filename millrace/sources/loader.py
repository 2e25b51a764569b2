"""One loader for several file types, and readers of schemas and of enveloped records."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUILT_IN = ("csv", "json", "parquet", "text", "xml")
NEED_A_CONNECTOR = {"avro": "avro", "delta": "delta", "xlsx": "excel"}


def load(
    spark: SparkSession, path: str, file_type: str, schema: T.StructType | str | None = None, csv_header: bool = True,
    json_multiline: bool = False, options: dict[str, str] | None = None,
) -> DataFrame:
    """Read files of one type. Parquet brings its own schema, so a given one is not applied."""
    options = dict(options or {})
    if file_type == "csv" and csv_header:
        options.setdefault("header", "true")
    if file_type == "json" and json_multiline:
        options.setdefault("multiLine", "true")
    if file_type == "xlsx":
        options.setdefault("header", "true")
    if file_type not in BUILT_IN and file_type not in NEED_A_CONNECTOR:
        raise ValueError(f"unsupported file type {file_type}")
    reader = spark.read.format(NEED_A_CONNECTOR.get(file_type, file_type)).options(**options)
    if schema is not None and file_type not in ("parquet", "delta", "avro"):
        reader = reader.schema(schema)
    try:
        df = reader.load(path)
    except Exception as error:
        if file_type in NEED_A_CONNECTOR and re.search("DATA_SOURCE_NOT_FOUND|find data source", str(error)):
            raise ValueError(f"reading {file_type} needs a connector that is not on the class path") from error
        raise
    return parse_envelope(df, "Body") if file_type == "avro" else df


def read_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """A schema kept as JSON in a file; None (infer instead) if it is missing or unreadable."""
    try:
        text = spark.read.text(path, wholetext=True).first()
        return T.StructType.fromJson(json.loads(text["value"]))
    except Exception:
        return None


def parse_envelope(df: DataFrame, body: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Records wrapped as text or bytes in one column: parse the JSON and return its fields.

    Without a schema one is inferred from all bodies, in a distributed pass of its own.
    """
    text = df.select(F.col(body).cast("string").alias("body"))
    if schema is None:
        schema = infer_json_schema(text, "body")
    return text.select(F.from_json("body", schema).alias("r")).select("r.*")


def infer_json_schema(df: DataFrame, column: str) -> str:
    """Type text, STRUCT<...>, of the JSON objects that a column holds, over all rows.

    Per-row types are combined in a partial aggregate inside the JVM. Where rows disagree, or
    hold only nulls, the field is a string; fractions are doubles. Text that is no JSON is skipped.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(column)))).first()[0]
    if not found.startswith("OBJECT<"):
        raise ValueError(f"column {column} does not hold JSON objects but {found}")
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", found)
    ddl = re.sub(r"(?<=: )(VOID|VARIANT)\b|(?<=ARRAY<)(VOID|VARIANT)\b", "STRING", ddl)
    # Whole numbers beyond a long keep their digits; fractions are doubles.
    ddl = re.sub(r"\bDECIMAL\(\d+,\s*(?!0\))\d+\)", "DOUBLE", ddl)
    return ddl


def retype(df: DataFrame, types: dict[str, str], replace: dict[str, tuple[str, object]] | None = None) -> DataFrame:
    """Cast text columns; a value that does not fit becomes NULL.

    ``replace`` gives, per column, a marker text and the value that stands for it.
    """
    out = {}
    for name, type_name in types.items():
        value = F.col(name).try_cast(type_name)
        if replace and name in replace:
            marker, substitute = replace[name]
            value = F.when(F.col(name) == marker, F.lit(substitute).cast(type_name)).otherwise(value)
        out[name] = value
    return df.withColumns(out)
