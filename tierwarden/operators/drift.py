"""Tag drift: three-way diff, change log, snapshot refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwarden.functions.text import blank_if_null, column_fqn, strip
from tierwarden.model import TAG_FIELDS, UNCLASSIFIED
from tierwarden.operators.catalog import grouped

KEY = ["table_name", "column_name"]
STORED_EMPTY = {"data_classification": UNCLASSIFIED}


def _shown(value: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("(none)"))


def diff_tags(source: DataFrame, stored: DataFrame, fields: tuple[str, ...] = TAG_FIELDS,
              empty_equivalents: dict[str, str] | None = None, include_removed: bool = False) -> DataFrame:
    """(fqn, status, field, old_value, new_value) of ``source`` against ``stored``.

    Both sides carry ``fqn`` and the tag fields, one row per column.  ``new`` and
    ``unchanged`` columns give one row, ``changed`` ones a row per field.
    ``empty_equivalents`` names, per field, the stored text that equals "no tag";
    by default only the classification has one, so an untagged encryption flag
    stored as 'No' is reported on every run - add ``'encryption_required': 'No'``
    to silence that.  Removed columns are reported only when asked for.
    The sides are unique on ``fqn``, so the join cannot be skewed, and the five
    comparisons are made in place: one join, no unpivot and no second pass.
    """
    equal_empty = STORED_EMPTY if empty_equivalents is None else empty_equivalents
    src = source.select("fqn", *[strip(blank_if_null(f)).alias(f"n_{f}") for f in fields],
                        F.lit(True).alias("in_source"))
    old = stored.select("fqn", *[strip(blank_if_null(f)).alias(f"o_{f}") for f in fields],
                        F.lit(True).alias("in_store"))
    both = src.join(old, "fqn", "full_outer" if include_removed else "left")

    def delta(f: str) -> Column:
        new, was = F.col(f"n_{f}"), F.col(f"o_{f}")
        differs = new != was
        if f in equal_empty:
            differs = differs & ~((was == equal_empty[f]) & (new == ""))
        return F.when(differs, F.struct(F.lit(f).alias("field"), _shown(was).alias("old_value"),
                                        _shown(new).alias("new_value")))

    deltas = F.filter(F.array(*[delta(f) for f in fields]), lambda d: d.isNotNull())
    in_both = F.col("in_source").isNotNull() & F.col("in_store").isNotNull()
    status = (F.when(F.col("in_store").isNull(), F.lit("new"))
              .when(F.col("in_source").isNull(), F.lit("removed"))
              .when(F.size("deltas") > 0, F.lit("changed")).otherwise(F.lit("unchanged")))
    return (both.select("fqn", "in_source", "in_store", F.when(in_both, deltas).alias("deltas"))
            .select("fqn", status.alias("status"), F.explode_outer("deltas").alias("d"))
            .select("fqn", "status", "d.field", "d.old_value", "d.new_value"))


def diff_summary(diff: DataFrame) -> DataFrame:
    """Counts of a diff; ``changed`` counts fields, the others count columns."""
    return diff.agg(*[F.count_if(F.col("status") == s).alias(s)
                      for s in ("new", "changed", "unchanged", "removed")])


def with_fqn(tags: DataFrame) -> DataFrame:
    return tags.withColumn("fqn", column_fqn("table_name", "column_name"))


def detect_tag_changes(current: DataFrame, snapshot: DataFrame, run_ts=None,
                       fields: tuple[str, ...] = TAG_FIELDS) -> DataFrame:
    """Change-log rows of ``current`` against the last snapshot (NULL equals empty).

    A new column logs its non-empty tags; a new column without tags logs nothing;
    a column gone from ``current`` is not looked at.
    """
    snap = snapshot.select(*KEY, *[F.col(f).alias(f"o_{f}") for f in fields])
    both = current.select(*KEY, *fields).join(snap, KEY, "left")

    def delta(f: str) -> Column:
        return F.when(blank_if_null(f"o_{f}") != blank_if_null(f),
                      F.struct(F.lit(f.upper()).alias("tag_field"), F.col(f"o_{f}").alias("old_value"),
                               F.col(f).alias("new_value")))

    deltas = F.filter(F.array(*[delta(f) for f in fields]), lambda d: d.isNotNull())
    stamp = (F.current_timestamp() if run_ts is None else F.lit(run_ts)).cast("timestamp")
    rows = both.select(*KEY, F.explode(deltas).alias("d")).select(
        *KEY, "d.tag_field", "d.old_value", "d.new_value", stamp.alias("changed_at"))
    return rows.select(
        F.xxhash64(*KEY, "tag_field", "changed_at").alias("change_id"), "changed_at", *KEY,
        "tag_field", "old_value", "new_value", F.lit("PENDING").alias("sync_status"),
        F.lit(None).cast("timestamp").alias("synced_at"))


def snapshot_rows(current: DataFrame, run_ts=None, fields: tuple[str, ...] = TAG_FIELDS) -> DataFrame:
    """Snapshot rows of the current columns."""
    stamp = (F.current_timestamp() if run_ts is None else F.lit(run_ts)).cast("timestamp")
    return current.select(F.xxhash64(*KEY).alias("snapshot_id"), *KEY, *fields, stamp.alias("captured_at"))


def merge_snapshot(snapshot: DataFrame, current: DataFrame, run_ts=None,
                   fields: tuple[str, ...] = TAG_FIELDS) -> DataFrame:
    """Refreshed snapshot: current columns updated or added, all others kept as they are."""
    stamp = (F.current_timestamp() if run_ts is None else F.lit(run_ts)).cast("timestamp")
    old = snapshot.select(*KEY, *[F.col(f).alias(f"o_{f}") for f in fields],
                          F.col("captured_at").alias("o_captured_at"))
    new = current.select(*KEY, *fields, F.lit(True).alias("seen"))
    both = old.join(new, KEY, "full_outer")
    seen = F.col("seen").isNotNull()
    return both.select(
        F.xxhash64(*KEY).alias("snapshot_id"), *KEY,
        *[F.when(seen, F.col(f)).otherwise(F.col(f"o_{f}")).alias(f) for f in fields],
        F.when(seen, stamp).otherwise(F.col("o_captured_at")).alias("captured_at"))


def pending_changes(log: DataFrame) -> DataFrame:
    """Changes not yet synced, newest first."""
    return (log.where(F.col("sync_status") == "PENDING")
            .orderBy(F.col("changed_at").desc(), *KEY, "tag_field")
            .select("changed_at", *KEY, "tag_field", "old_value", "new_value"))


def mark_synced(log: DataFrame, run_ts=None) -> DataFrame:
    pending = F.col("sync_status") == "PENDING"
    stamp = (F.current_timestamp() if run_ts is None else F.lit(run_ts)).cast("timestamp")
    return log.withColumns({"synced_at": F.when(pending, stamp).otherwise(F.col("synced_at")),
                            "sync_status": F.when(pending, F.lit("SYNCED")).otherwise(F.col("sync_status"))})


def column_history(log: DataFrame, table: str, column: str) -> DataFrame:
    """Every change of one column, newest first."""
    return (log.where((F.col("table_name") == table) & (F.col("column_name") == column))
            .orderBy(F.col("changed_at").desc(), "tag_field"))


def tag_intervals(changes: DataFrame, order: list[str], key: tuple[str, ...] = (*KEY, "tag_field")) -> DataFrame:
    """When each value of a column's tag held: the key, value, valid_from, valid_to (exclusive, NULL while it holds).

    ``changes`` has the key, ``value`` and the ``order`` columns, the first of which is the time; of several values at one
    time only the last one held. A value set again without another in between continues its interval.
    """
    at = order[0]
    last = (grouped(changes, [*key, at]).agg(F.max(F.struct(*order[1:], "value")).alias("_last"))
            .select(*key, at, F.col("_last.value").alias("value")))
    history = Window.partitionBy(*key).orderBy(at)      # the statements on one tag of one column, one row for each time
    before = last.withColumn("_first", F.row_number().over(history) == 1).withColumn("_before", F.lag("value").over(history))
    starts = before.where(F.col("_first") | ~F.col("value").eqNullSafe(F.col("_before")))
    return starts.select(*key, "value", F.col(at).alias("valid_from"), F.lead(at).over(history).alias("valid_to"))


def log_intervals(log: DataFrame) -> DataFrame:
    """``tag_intervals`` of a change log."""
    return tag_intervals(log.withColumnRenamed("new_value", "value"), ["changed_at", "change_id"])


def catalog_at(intervals: DataFrame, moments: DataFrame, fields: tuple[str, ...] = TAG_FIELDS) -> DataFrame:
    """Wide tags of the columns at the moments asked for: an as-of join of ``moments`` (table_name, column_name, moment).

    One row for each moment of a column, with NULL for tags without a value then. The equi-join is on the column, so that a column
    with a long history or many questions is split by adaptive execution; at most one interval of each tag fits.
    """
    ask, held = moments.select(*KEY, "moment").distinct().alias("m"), intervals.alias("i")
    fits = (F.col("m.moment") >= F.col("i.valid_from")) & (F.col("i.valid_to").isNull() | (F.col("m.moment") < F.col("i.valid_to")))
    same = [F.col(f"m.{k}") == F.col(f"i.{k}") for k in KEY]
    both = ask.join(held, (same[0]) & (same[1]) & fits, "left")
    return (both.groupBy(*[F.col(f"m.{k}").alias(k) for k in KEY], F.col("m.moment").alias("moment"))
            .agg(*[F.max(F.when(F.col("i.tag_field") == f.upper(), F.col("i.value"))).alias(f) for f in fields]))


def change_message(count: int) -> str:
    return f"OK: {count} tag changes logged."
