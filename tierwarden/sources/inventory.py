"""Sources: entity scans, schema and table inventories, tag references, registries."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwarden.model import (
    DATABASE, SCHEMA, grants_df, local_df, policies_df, taxonomy_df,
)


def read_entity(spark: SparkSession, path: str) -> DataFrame:
    """Scan a stored table, whole."""
    return spark.read.parquet(path)


def _char_length(field: T.StructField) -> int | None:
    """Declared length of a char or varchar column, which Spark reads as text and notes in the field's metadata."""
    found = re.fullmatch(r"(?:var)?char\((\d+)\)", str(field.metadata.get("__CHAR_VARCHAR_TYPE_STRING", "")))
    return int(found[1]) if found else None


def _sql_type(dtype: T.DataType) -> tuple[str, int | None]:
    """Warehouse type name and numeric precision of a Spark type."""
    if isinstance(dtype, T.DecimalType):
        return "NUMBER", dtype.precision
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return "NUMBER", 38
    simple = {T.StringType: "TEXT", T.DateType: "DATE", T.BooleanType: "BOOLEAN", T.DoubleType: "FLOAT",
              T.FloatType: "FLOAT", T.TimestampNTZType: "TIMESTAMP_NTZ", T.TimestampType: "TIMESTAMP_TZ"}
    return simple.get(type(dtype), dtype.simpleString().upper()), None


def catalog_from_schemas(spark: SparkSession, frames: dict[str, DataFrame],
                         defaults: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Column inventory of the given frames, from their schemas alone (no data is read)."""
    rows = []
    for table, df in frames.items():
        given = (defaults or {}).get(table.upper(), {})
        for position, field in enumerate(df.schema.fields, 1):
            kind, precision = _sql_type(field.dataType)
            rows.append((SCHEMA, table.upper(), field.name.upper(), kind, _char_length(field), precision,
                         "YES" if field.nullable else "NO", given.get(field.name), position))
    return local_df(spark, rows, "table_schema string, table_name string, column_name string, "
                                 "data_type string, character_maximum_length int, numeric_precision int, "
                                 "is_nullable string, column_default string, ordinal_position int")


def table_inventory(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """table_name, row_count, bytes, created - from file metadata and row counts only.

    Rows are first counted per file (partial aggregation leaves one row per file
    and task), so size and time of each file are taken once.
    """
    parts = []
    for table, path in paths.items():
        per_file = (spark.read.parquet(path)
                    .groupBy(F.col("_metadata.file_path").alias("file"),
                             F.col("_metadata.file_size").alias("size"),
                             F.col("_metadata.file_modification_time").alias("modified"))
                    .agg(F.count(F.lit(1)).alias("n")))
        parts.append(per_file.agg(
            F.lit(table).alias("table_name"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.sum("size").alias("bytes"), F.min("modified").alias("created")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def tag_refs(assigned: DataFrame, database: str = DATABASE, schema: str = SCHEMA) -> DataFrame:
    """Nine-column tag references from (table_name, column_name, tag_name, tag_value)."""
    return assigned.select(
        F.lit(database).alias("tag_database"), F.lit(schema).alias("tag_schema"),
        F.upper("tag_name").alias("tag_name"), "tag_value",
        F.lit(database).alias("object_database"), F.lit(schema).alias("object_schema"),
        F.col("table_name").alias("object_name"), "column_name", F.lit("COLUMN").alias("domain"))


def short_refs(refs: DataFrame, table: str | None = None) -> DataFrame:
    """Four-column form of the tag references, of one table or of all."""
    out = refs if table is None else refs.where(F.col("object_name") == table)
    return out.select(F.col("object_name").alias("table_name"), "column_name", "tag_name", "tag_value")


def policy_refs(refs: DataFrame, tables: list[str] | None = None) -> DataFrame:
    """Policy references of the named tables; none named means all, none found means empty."""
    return refs if tables is None else refs.where(F.col("table_name").isin([t.upper() for t in tables]))


def list_tags(spark: SparkSession) -> DataFrame:
    return taxonomy_df(spark)


def list_policies(spark: SparkSession, kind: str | None = None, name: str | None = None) -> DataFrame:
    """Registered policies, optionally of one kind (MASKING, ROW_ACCESS) or of one name."""
    out = policies_df(spark)
    if kind is not None:
        out = out.where(F.col("type") == kind)
    if name is not None:
        out = out.where(F.col("name") == name.upper())
    return out


def grants_for(spark: SparkSession, role: str) -> DataFrame:
    """Grants held by one role."""
    return grants_df(spark, role)
