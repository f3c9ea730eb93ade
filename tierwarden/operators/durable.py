"""Lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session (tests, laptops) may fall back to a folder of its
    own; a cluster session without the setting is refused, because executors
    cannot see a machine-local folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    named = tempfile.mkdtemp(prefix="tierwarden-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tierwarden/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and return a frame that reads it back."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def write_through(df: DataFrame, path: str) -> DataFrame:
    """Store ``df`` as Parquet and return a frame that reads the stored rows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 50_000


def keyed(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as the right side of a join, of so many ``rows``: with many, both sides are sorted and merged.

    Alike names make Parquet files a small part of their rows, so the planner, going by file sizes, would
    collect millions of them on the driver and send them to every executor.
    """
    return df.hint("merge") if rows > BROADCAST_ROWS else df
