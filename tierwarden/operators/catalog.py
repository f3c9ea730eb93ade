"""Tag assignment, validation, pivoting and classification roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwarden.functions.text import or_default, strip
from tierwarden.model import (
    INSERT_DEFAULTS, NOW, RANKS, REQUIRED, TAG_DEFAULTS, TAG_FIELDS, TIER_OVERRIDES,
)

KEY = ["table_name", "column_name"]


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name, built in pairs: every step is analysed anew, so a chain would cost n squared."""
    while len(frames) > 1:
        pairs = [frames[i:i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


def grouped(df: DataFrame, keys: list[str]):
    """Group by ``keys`` led by their hash.

    Text and struct results make Spark aggregate by sorting; table and column
    names share long prefixes, and the hash settles nearly every comparison on
    one number.
    """
    return df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys)


# -- tags ------------------------------------------------------------------

def normalise_refs(refs: DataFrame) -> DataFrame:
    """Upper-case table, column and tag names (tags are created in lower case, read in upper)."""
    return refs.withColumns({c: F.upper(c) for c in KEY + ["tag_name"]})


def assign_tags(assignments: DataFrame, order: list[str]) -> DataFrame:
    """One value per (column, tag): the last assignment in ``order`` wins.

    The winner is a ``max`` over a struct, so it is combined on the map side; a
    column that received most of the assignments is no heavier to shuffle than
    any other, and nothing is sorted within a group.
    """
    last = F.max(F.struct(*order, "tag_value"))
    return (grouped(assignments, KEY + ["tag_name"]).agg(last.alias("_last"))
            .select(*KEY, "tag_name", F.col("_last.tag_value").alias("tag_value")))


def pivot_tags(refs: DataFrame, keys: list[str] = KEY, fields: tuple[str, ...] = TAG_FIELDS) -> DataFrame:
    """One row per column, one field per tag (NULL where the tag is not set)."""
    tag = F.upper("tag_name")
    return grouped(refs, keys).agg(*[
        F.max(F.when(tag == f.upper(), F.col("tag_value"))).alias(f) for f in fields]).drop("_hash")


def current_tags(assignments: DataFrame, order: list[str], keys: list[str] = KEY,
                 fields: tuple[str, ...] = TAG_FIELDS) -> DataFrame:
    """``pivot_tags(assign_tags(...))`` in one aggregation and one shuffle."""
    tag = F.upper("tag_name")
    entry = F.struct(*order, "tag_value")
    last = [F.max(F.when(tag == f.upper(), entry)).alias(f"_{f}") for f in fields]
    return (grouped(assignments, keys).agg(*last)
            .select(*keys, *[F.col(f"_{f}.tag_value").alias(f) for f in fields]))


def tags_before(assignments: DataFrame, order: list[str], cut: Column, keys: list[str] = KEY,
                fields: tuple[str, ...] = TAG_FIELDS) -> DataFrame:
    """``current_tags`` of all assignments (``fields``) and of those where ``cut`` holds (``was_`` + field), in one pass.

    ``known`` tells whether the column had any assignment before the cut.
    """
    tag, entry = F.upper("tag_name"), F.struct(*order, "tag_value")
    last = [F.max(F.when((tag == f.upper()) & test, entry)).alias(f"_{name}{f}")
            for f in fields for name, test in (("", F.lit(True)), ("was_", cut))]
    return (grouped(assignments, keys).agg(*last, F.max(F.coalesce(cut, F.lit(False))).alias("known"))
            .select(*keys, "known", *[F.col(f"_{n}{f}.tag_value").alias(f"{n}{f}") for n in ("", "was_") for f in fields]))


def column_catalog(tags: DataFrame, inventory: DataFrame, schema_name: str | None = None) -> DataFrame:
    """Pivoted tags joined with the column inventory; columns missing on either side drop out.

    Both have a row for each column, and files of names are far smaller than their rows: neither is collected to be broadcast.
    """
    known = inventory if schema_name is None else inventory.where(F.col("table_schema") == schema_name)
    known = known.drop("table_schema")
    rest = [c for c in known.columns if c not in KEY]
    return known.join(tags.hint("merge"), KEY).select(*KEY, *rest, *TAG_FIELDS)


def fill_tag_defaults(catalog: DataFrame, trim: bool = False) -> DataFrame:
    """Stored form of a catalog row: missing or empty tags take their default.

    ``trim`` also removes surrounding whitespace (the incremental path does, the
    full load does not).
    """
    def value(name: str) -> Column:
        return strip(name) if trim else F.col(name)

    out = {f: or_default(value(f), TAG_DEFAULTS[f]) for f in TAG_FIELDS}
    if "data_type" in catalog.columns:
        out["data_type"] = or_default(value("data_type"), "UNKNOWN")
    if "is_nullable" in catalog.columns:
        out["is_nullable"] = or_default(value("is_nullable"), "YES")
    if "ordinal_position" in catalog.columns:
        out["ordinal_position"] = F.coalesce(F.col("ordinal_position"), F.lit(0))
    return catalog.withColumns(out)


def validate_tags(refs: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Rows whose tag is unknown or whose value is outside the tag's closed list."""
    names = taxonomy.select(F.upper("tag_name").alias("_tag"), "allowed_values", F.lit(True).alias("_known"))
    judged = refs.join(names, F.upper(refs.tag_name) == F.col("_tag"), "left")
    problem = (F.when(F.col("_known").isNull(), F.lit("UNKNOWN TAG"))
               .when(F.col("allowed_values").isNotNull()
                     & ~F.array_contains("allowed_values", F.col("tag_value")),
                     F.lit("VALUE NOT ALLOWED")))
    return (judged.withColumn("violation", problem).where(F.col("violation").isNotNull())
            .select(*refs.columns, "violation"))


def discover_governed_tables(refs: DataFrame, policy_refs: DataFrame) -> DataFrame:
    """Tables with at least one column tag or one row access policy."""
    tagged = refs.where(F.col("domain") == "COLUMN").select(F.col("object_name").alias("table_name"))
    ruled = policy_refs.where(F.col("policy_kind") == "ROW_ACCESS_POLICY").select("table_name")
    return tagged.union(ruled).distinct()


# -- constraints -----------------------------------------------------------

def apply_defaults(df: DataFrame, table: str, run_ts=None) -> DataFrame:
    """Column defaults for rows that left them out; one time stamp per run."""
    def default(column: str, value) -> Column:
        if value is NOW:
            stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts)
            return stamp.cast(df.schema[column].dataType)
        return F.lit(value)

    return df.withColumns({
        c: F.coalesce(F.col(c), default(c, v))
        for c, v in INSERT_DEFAULTS[table.upper()].items() if c in df.columns})


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Key values held by more than one row."""
    return (df.groupBy(F.col(key).cast("string").alias("key_value"))
            .agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1))


def check_not_null(df: DataFrame, table: str, required: list[str] | None = None) -> DataFrame:
    """NULLs per required column, in one pass; only offending columns are returned."""
    names = [c for c in required or REQUIRED[table.upper()] if c in df.columns]
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return (counted.unpivot([], names, "column_name", "null_rows")
            .where(F.col("null_rows") > 0)
            .select(F.lit(table.upper()).alias("table_name"), "column_name", "null_rows"))


# -- roll-ups --------------------------------------------------------------

def tier_rank(tier: Column | str) -> Column:
    col = F.col(tier) if isinstance(tier, str) else tier
    picked = F.when(col == "Restricted", F.lit(1))
    for name, rank in list(RANKS.items())[1:]:
        picked = picked.when(col == name, F.lit(rank))
    return picked


def tier_name(rank: Column) -> Column:
    picked = None
    for name, value in RANKS.items():
        picked = F.when(rank == value, F.lit(name)) if picked is None else picked.when(rank == value, F.lit(name))
    return picked


def rollup_classification(catalog: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """Most sensitive tier per table: (table_name, sensitivity_rank, data_classification).

    ``overrides`` fixes the tier of named tables; audit records are Internal
    by default although some of their columns are not.
    """
    overrides = TIER_OVERRIDES if overrides is None else overrides
    worst = catalog.groupBy("table_name").agg(F.min(tier_rank("data_classification")).alias("_rank"))
    rank = F.col("_rank")
    for table, tier in overrides.items():
        rank = F.when(F.col("table_name") == table, F.lit(RANKS[tier])).otherwise(rank)
    return worst.select("table_name", rank.alias("sensitivity_rank"),
                        tier_name(rank).alias("data_classification"))


def record_tier(df: DataFrame, tiers: dict[str, str]) -> Column:
    """Most sensitive tier over the columns that hold a value, row by row.

    ``tiers`` maps column name to tier.  Columns of one tier share one test and
    ``coalesce`` stops at the first tier present, so nothing is exploded.
    """
    present = {c.upper() for c in df.columns}

    def any_value(tier: str) -> Column | None:
        names = [c for c, t in tiers.items() if t == tier and c.upper() in present]
        return F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(tier)) for c in names]) if names else None

    found = [t for t in map(any_value, RANKS) if t is not None]
    return F.coalesce(*found, F.lit(None).cast("string"))


# -- counts ----------------------------------------------------------------

def tier_coverage(catalog: DataFrame) -> DataFrame:
    """Columns per classification."""
    return (catalog.where(F.col("data_classification").isNotNull())
            .groupBy(F.col("data_classification").alias("classification"))
            .agg(F.count(F.lit(1)).alias("column_count")))


def columns_per_table(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("table_name").agg(F.count(F.lit(1)).alias("column_count"))
