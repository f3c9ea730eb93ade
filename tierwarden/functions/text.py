"""Small scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierwarden.model import DATABASE, SCHEMA


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def or_default(value: Column | str, default) -> Column:
    """``default`` where the value is NULL or the empty string."""
    return F.coalesce(F.nullif(_col(value), F.lit("")), F.lit(default))


def strip(value: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` drops spaces only)."""
    return F.regexp_replace(F.regexp_replace(_col(value), r"^\s+", ""), r"\s+$", "")


def blank_if_null(value: Column | str) -> Column:
    return F.coalesce(_col(value), F.lit(""))


def table_fqn(table: Column | str, database: str = DATABASE, schema: str = SCHEMA) -> Column:
    """``db.schema.table``; NULL when the table name is NULL."""
    return F.concat(F.lit(f"{database}.{schema}."), _col(table))


def column_fqn(table: Column | str, column: Column | str,
               database: str = DATABASE, schema: str = SCHEMA) -> Column:
    """``db.schema.table.column``; NULL when either part is NULL."""
    return F.concat(table_fqn(table, database, schema), F.lit("."), _col(column))


def or_false(value: Column | str) -> Column:
    return F.coalesce(_col(value), F.lit(False))
