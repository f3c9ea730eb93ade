"""Incremental tag sync of a stored column catalog, and the drift job."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwarden.model import (
    CATALOG_SCHEMA, CHANGE_LOG_SCHEMA, EDGE_SCHEMA, SYNC_RUN_SCHEMA, TAG_FIELDS, TAG_SNAPSHOT_SCHEMA, VERTEX_SCHEMA,
    local_df, tiers_df,
)
from tierwarden.operators import drift
from tierwarden.operators.catalog import fill_tag_defaults, union_all
from tierwarden.operators.durable import keyed, scratch_path, write_through
from tierwarden.operators.graph import as_vertices, catalog_edges, classified_as, databases_frame, schemas_frame, tables_frame
from tierwarden.sources.merged import Keyed, MergedStore, MergedTable
from tierwarden.sources.state import BatchLog

STORED_SCHEMA = T.StructType(
    [T.StructField("fqn", T.StringType())] + CATALOG_SCHEMA.fields
    + [T.StructField("sync_version", T.LongType()), T.StructField("last_tag_sync", T.TimestampType())])
EDGE_KEYS = ("src", "dst", "type")


@dataclass
class CatalogStore:
    """Stored catalog with its graph (chain vertices and edges) and sync runs, published together.

    A sync adds the rows it touches as small parts, so it costs what it changes, not what is stored.
    """

    spark: SparkSession
    path: str

    def __post_init__(self):
        tables = {"catalog": Keyed(STORED_SCHEMA, ("fqn",)), "vertices": Keyed(VERTEX_SCHEMA, ("id",)),
                  "edges": Keyed(EDGE_SCHEMA, EDGE_KEYS),
                  "sync_run": Keyed(T.StructType([T.StructField("version", T.LongType()), *SYNC_RUN_SCHEMA.fields]), ("version",))}
        self.store = MergedStore(self.spark, self.path, tables)
        self.catalog, self.vertices, self.edges = (
            MergedTable(self.spark, self.path, tables[n], self.store, n) for n in ("catalog", "vertices", "edges"))

    def runs(self) -> DataFrame:
        """One row for each published sync."""
        return self.store.read("sync_run").drop("version")


def chain_vertices(columns: DataFrame, run_ts, platform: str = "warehouse") -> DataFrame:
    """Database, Schema and Table vertices above ``columns(table_name, ...)``."""
    spark = columns.sparkSession
    return union_all([as_vertices(databases_frame(spark, platform, run_ts), "Database"), as_vertices(schemas_frame(spark), "Schema"),
                      as_vertices(tables_frame(columns, run_ts, platform), "Table")])


def edge_changes(before: DataFrame, after: DataFrame, rows: int = 0) -> DataFrame:
    """Edges that the written columns ``after`` need, and those to be removed (``_gone``).

    The chain edges above the columns are needed; CLASSIFIED_AS is derived anew from what the columns were and are.
    ``rows`` is the number of columns written, where it is known.
    """
    spark = after.sparkSession
    needed = catalog_edges(spark, after).unionByName(classified_as(after, tiers_df(spark)))
    was = classified_as(before.join(keyed(after.select("fqn"), rows), "fqn", "left_semi"), tiers_df(spark))
    gone = was.join(keyed(needed.select(*EDGE_KEYS), rows), list(EDGE_KEYS), "left_anti")
    return needed.withColumn("_gone", F.lit(False)).unionByName(gone.withColumn("_gone", F.lit(True)).select(*needed.columns, "_gone"))


def written_rows(stored: DataFrame, rows: DataFrame, run_ts) -> DataFrame:
    """Source rows as they are stored; the version of a column goes up by one each time it is written."""
    old = stored.select("fqn", F.col("sync_version").alias("_before"))
    return rows.join(old, "fqn", "left").select(
        "fqn", *[f.name for f in CATALOG_SCHEMA.fields], (F.coalesce("_before", F.lit(0)) + 1).cast("long").alias("sync_version"),
        F.lit(run_ts).cast("timestamp").alias("last_tag_sync"))


def sync_tags(source: DataFrame, store: CatalogStore, dry_run: bool = False, changed_only: bool = False,
              empty_equivalents: dict[str, str] | None = None, run_ts: datetime | None = None,
              version: int | None = None) -> Row:
    """One sync cycle: diff ``source`` against the store, apply it, return the counts.

    ``source`` is a column catalog as pivoted from tag references (an empty one
    is fine), of all columns or just of those that may have changed.  Nothing is written on a dry run, not even working copies, or when nothing
    differs.  When something differs all source columns are rewritten, or with
    ``changed_only`` just the new and changed ones.  Catalog, graph and run are
    published by one commit, so a crash leaves all of them as they were.
    ``version`` makes a replay take the place of its own earlier attempt.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    spark = source.sparkSession
    source = drift.with_fqn(source)
    if not dry_run:
        # Both are stored once: diff, counts and rewrite must see the same source, and
        # none of them should pivot the tag references again.
        source = write_through(source, scratch_path(spark, "source"))
    known = store.store.most("catalog", before=version)
    stored = keyed(store.catalog.read(before=version, near=source), known)
    diff = drift.diff_tags(source, stored, TAG_FIELDS, empty_equivalents)
    if not dry_run:
        diff = write_through(diff, scratch_path(spark, "diff"))
    counts = diff.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("new", "changed", "unchanged")],
                      F.count_distinct(F.when(F.col("status") == "changed", F.col("fqn"))).alias("touched")).first()
    source_columns = counts["new"] + counts["touched"] + counts["unchanged"]
    written = 0
    if not dry_run and (counts["new"] or counts["changed"]):
        rows = fill_tag_defaults(source, trim=True)
        if changed_only:
            keys = diff.where(F.col("status").isin("new", "changed")).select("fqn")
            rows = rows.join(keyed(keys, counts["new"] + counts["changed"]), "fqn", "left_semi")
        written = counts["new"] + counts["touched"] if changed_only else source_columns
    summary = Row(sync_ts=run_ts, source_columns=source_columns, catalog_columns=store.store.total("catalog", before=version),
                  new=counts["new"], changed=counts["changed"], unchanged=counts["unchanged"], written=written)
    if written:
        after = write_through(written_rows(stored, rows, run_ts), scratch_path(spark, "written"))
        # looked through for buckets, then joined and written
        edges = write_through(edge_changes(stored, after, written), scratch_path(spark, "edges"))
        chain = write_through(chain_vertices(after, run_ts), scratch_path(spark, "chain"))
        above = keyed(store.vertices.read(before=version, near=chain).select("id"), store.store.most("vertices", before=version))
        known = keyed(store.edges.read(before=version, near=edges).select(*EDGE_KEYS, F.lit(True).alias("_known")),
                      store.store.most("edges", before=version))
        number = version if version is not None else (-1 if (last := store.store.version()) is None else last) + 1
        run = local_df(spark, [(number, *summary)], store.store.tables["sync_run"].schema)
        store.store.commit({
            "catalog": after,
            # what exists keeps its properties
            "vertices": chain.join(above, "id", "left_anti"),
            "edges": edges.join(known, list(EDGE_KEYS), "left").where("_gone or _known is null"),
            "sync_run": run}, version, totals={"catalog": summary.catalog_columns + counts["new"]})
    return summary


@dataclass
class DriftStore:
    """Tag snapshot and change log of the drift job."""

    spark: SparkSession
    path: str

    def __post_init__(self):
        self.snapshot = MergedTable(self.spark, f"{self.path}/tag_snapshot", Keyed(TAG_SNAPSHOT_SCHEMA, tuple(drift.KEY)))
        self.log = BatchLog(self.spark, f"{self.path}/tag_change_log", CHANGE_LOG_SCHEMA)


def record_drift(current: DataFrame, store: DriftStore, run_ts: datetime | None = None,
                 version: int | None = None) -> int:
    """Log the changes since the last snapshot, then refresh the snapshot; returns the rows logged.

    ``current`` holds all columns or just those that may have changed: others are neither looked at nor
    rewritten, so a run costs what it is given. The log is stored before the snapshot moves, and both are keyed by version,
    so a repeated run of one version replaces its own output.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    if version is None:
        last = store.snapshot.version()
        version = 0 if last is None else last + 1
    current = write_through(current, scratch_path(store.spark, "current"))
    before = store.snapshot.read(before=version, near=current)
    store.log.append(drift.detect_tag_changes(current, before, run_ts), version)
    logged = store.spark.read.parquet(f"{store.log.path}/batch_id={version}").count()
    store.snapshot.upsert(drift.snapshot_rows(current, run_ts), version)
    return logged
