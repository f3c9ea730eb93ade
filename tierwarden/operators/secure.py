"""Role-aware reads: row rule on raw values first, then column masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwarden.functions.policies import MASKS, ROW_RULES, Role
from tierwarden.model import LABEL_OF, MASK_BINDINGS, ROW_BINDINGS

FREE_TABLES: set[str] = set()


def declare_free(table: str) -> None:
    """Allow unmasked reads of a table that is not governed."""
    FREE_TABLES.add(table.upper())


def _known(table: str, *bindings) -> str:
    """The table's name; an error when it is neither governed, bound nor declared free."""
    name = table.upper()
    if name not in FREE_TABLES and name not in LABEL_OF and not any(name in b for b in bindings):
        raise ValueError(f"{table} is not a governed table; declare_free() it to read it without policies")
    return name


def apply_masks(df: DataFrame, table: str, role: Role,
                bindings: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Replace each bound column by its masked form, keeping names and types.

    A table that is neither governed nor declared free, and a bound column that the
    frame lacks, are errors: a misspelt name must not show raw values.  A masked
    number too large for the column's type is NULL.
    """
    every = MASK_BINDINGS if bindings is None else bindings
    bound = every.get(_known(table, every, ROW_BINDINGS), {})
    by_name = {column.upper(): policy for column, policy in bound.items()}
    missing = sorted(set(by_name) - {c.upper() for c in df.columns})
    if missing:
        raise ValueError(f"{table} lacks the masked columns {', '.join(missing)}")

    def shown(field) -> Column:
        policy = by_name.get(field.name.upper())
        if policy is None:
            return F.col(field.name)
        masked = MASKS[policy.upper()](field.name, role)
        fits = masked.try_cast(field.dataType) if isinstance(field.dataType, T.DecimalType) else masked.cast(field.dataType)
        return fits.alias(field.name)

    return df.select([shown(f) for f in df.schema.fields])


def apply_masks_by_role_column(df: DataFrame, table: str, role_column: str,
                               bindings: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """As ``apply_masks`` with the reader's role taken from each row."""
    return apply_masks(df, table, F.col(role_column), bindings)


def apply_row_policy(df: DataFrame, table: str, role: Role,
                     bindings: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Keep the rows the role may see; a NULL decision hides the row."""
    every = ROW_BINDINGS if bindings is None else bindings
    bound = every.get(_known(table, every, MASK_BINDINGS))
    if bound is None:
        return df
    column, policy = bound
    if column.upper() not in {c.upper() for c in df.columns}:
        raise ValueError(f"{table} lacks {column}, which its row rule reads")
    return df.where(ROW_RULES[policy.upper()](F.col(column), role))


def secure(df: DataFrame, table: str, role: Role,
           mask_bindings: dict[str, dict[str, str]] | None = None,
           row_bindings: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """What ``role`` sees of ``table``; works on batch and streaming frames."""
    return apply_masks(apply_row_policy(df, table, role, row_bindings), table, role, mask_bindings)


def secure_view(df: DataFrame, table: str, role: str, name: str) -> DataFrame:
    """Publish the secured read as a temporary view and return it."""
    out = secure(df, table, role)
    out.createOrReplaceTempView(name)
    return out


def gate_records(records: DataFrame, can_access: DataFrame, role: str,
                 tier: str = "data_classification") -> DataFrame:
    """Keep the records whose tier ``role`` has direct access to."""
    allowed = can_access.where(F.col("role") == role).select(F.col("classification").alias(tier))
    return records.join(allowed, tier, "left_semi").select(records.columns)


def project_for_role(records: DataFrame, can_access: DataFrame, role: str,
                     fields: dict[str, str], notes: dict[str, str]) -> DataFrame:
    """Gate, then show ``fields`` (output -> source) and literal ``notes`` in place of the rest."""
    shown = [F.col(source).alias(out) for out, source in fields.items()]
    shown += [F.lit(text).alias(out) for out, text in notes.items()]
    return gate_records(records, can_access, role).select(*shown, F.lit(role).alias("accessing_as"))
