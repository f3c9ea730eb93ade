"""Structured Streaming forms: tag sync, drift detection, secured reads."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierwarden.operators.catalog import column_catalog, current_tags
from tierwarden.operators.secure import secure
from tierwarden.operators.sync import CatalogStore, DriftStore, record_drift, sync_tags


def read_files(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
               files_per_batch: int | None = None) -> DataFrame:
    """File stream over ``folder``; ``pattern`` picks the files."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _start(stream: DataFrame, on_batch, checkpoint: str, every: str | None, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def latest_tags(stream: DataFrame, order: list[str]) -> DataFrame:
    """Wide tags of the columns whose statements arrive (to be written in update mode).

    The last statement of every column and tag is keyed state of the stream, so a batch reads and
    writes the state of its own columns. The order columns are part of the state: how the
    statements are cut into batches, or that one comes late, does not change the outcome.
    The state has one row for each column; give the session the RocksDB state store where that exceeds executor memory.
    """
    return current_tags(stream, order)


def stream_detect_changes(stream: DataFrame, path: str, order: list[str],
                          every: str | None = None, run_ts: Callable[[int], datetime] | None = None) -> StreamingQuery:
    """Drift detection on arriving SET TAG statements; ``every`` None drains what is there.

    Batches are numbered by the engine and every output is keyed by that number,
    so a batch replayed after a failure replaces what its first attempt left.
    ``run_ts`` gives a batch's time stamp from its number (the present time by default).
    """
    def on_batch(touched: DataFrame, batch_id: int) -> None:
        record_drift(touched, DriftStore(touched.sparkSession, path), None if run_ts is None else run_ts(batch_id), version=batch_id)

    return _start(latest_tags(stream, order), on_batch, f"{path}/checkpoint", every, "update")


def stream_tag_sync(stream: DataFrame, path: str, order: list[str], inventory: DataFrame,
                    every: str | None = None, changed_only: bool = False,
                    empty_equivalents: dict[str, str] | None = None) -> StreamingQuery:
    """Catalog sync on arriving SET TAG statements: the columns they touch are compared and, as ``changed_only`` says, written."""
    def on_batch(touched: DataFrame, batch_id: int) -> None:
        sync_tags(column_catalog(touched, inventory), CatalogStore(touched.sparkSession, path), changed_only=changed_only,
                  empty_equivalents=empty_equivalents, version=batch_id)

    return _start(latest_tags(stream, order), on_batch, f"{path}/checkpoint", every, "update")


def stream_secure(stream: DataFrame, table: str, role: str, out: str, checkpoint: str,
                  every: str | None = None) -> StreamingQuery:
    """Secured rows of a governed table as they arrive, appended to a Parquet folder."""
    writer = (secure(stream, table, role).writeStream.format("parquet").outputMode("append")
              .option("path", out).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


