"""Logs with one folder for each batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierwarden.model import local_df


def exists_or_none(read):
    """Result of ``read()``, or None when the path is not there yet."""
    try:
        return read()
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return None
        raise


class BatchLog:
    """Append-only table with one folder per batch, so a replayed batch replaces itself."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def append(self, df: DataFrame, batch_id: int) -> None:
        df.select(self.schema.names).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self) -> DataFrame:
        found = exists_or_none(lambda: self.spark.read.schema(self.schema).parquet(self.path))
        return local_df(self.spark, [], self.schema) if found is None else found.select(self.schema.names)
