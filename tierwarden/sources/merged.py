"""Keyed tables kept as a base and small deltas, merged when they are read.

An upsert writes only its own rows, as one more part of the table. A part is a folder of Parquet files
split by a hash of the key (``bucket=``), so a reader that is interested in some keys opens their buckets alone.
Reading takes each key from its newest part; a part larger than all newer ones together is passed
through an anti join with their keys, not shuffled and grouped.

Parts are merged once a part is no longer twice as large as all newer ones together. So a table has at
most about log2(rows) parts, a row is rewritten about as often, and files of a base that
outweighs what arrives stay as they are. Removed keys are rows marked ``_gone`` until they are merged into the base.

The tables of a store are published together, by one commit file written last that names the parts of
every table. A job that dies half-way leaves parts nobody reads. Each attempt writes folders of its
own; of two writers that publish the same new version the second fails. The newest ``keep`` commits can be
read; older ones, and parts none of them names, are deleted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwarden.model import local_df
from tierwarden.operators.durable import keyed

_COMMITS = ("version long, attempt string, committed_at timestamp, totals map<string,long>, "
            "parts map<string,array<struct<folder:string,rows:bigint>>>")


@dataclass(frozen=True)
class Keyed:
    """A table's columns, and those that identify a row."""

    schema: T.StructType
    keys: tuple[str, ...]


def _same(a: str, b: str, keys: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


class MergedStore:
    """Keyed tables whose states are published together."""

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, Keyed], buckets: int = 8, keep: int = 10):
        self.spark, self.path, self.tables, self.buckets, self.keep = spark, path.rstrip("/"), tables, buckets, max(2, keep)

    # -- commits

    def _commits(self) -> list:
        folder = f"{self.path}/commits"
        if not self._files(folder).exists(self._path(folder)):
            return []
        found = self.spark.read.schema(_COMMITS).option("recursiveFileLookup", True).json(folder)
        return sorted(found.collect(), key=lambda r: r["version"])      # at most ``keep`` + 1, the others are deleted

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self, name: str):
        return self._path(name).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _newest(self, before: int | None = None):
        found = [c for c in self._commits() if before is None or c["version"] < before]
        return found[-1] if found else None

    def version(self, before: int | None = None) -> int | None:
        """Newest committed version, optionally older than ``before``."""
        newest = self._newest(before)
        return None if newest is None else newest["version"]

    def total(self, name: str, before: int | None = None) -> int:
        """Rows of a table: as the last commit stated it, else counted."""
        newest = self._newest(before)
        if newest is None:
            return 0
        stated = (newest["totals"] or {}).get(name)
        return self._merged(name, newest["parts"].get(name) or []).count() if stated is None else stated

    def most(self, name: str, before: int | None = None) -> int:
        """Rows of a table's parts: no fewer than the table has."""
        newest = self._newest(before)
        return 0 if newest is None else sum(p["rows"] for p in newest["parts"].get(name) or [])

    # -- reading

    def _bucket(self, name: str) -> Column:
        return F.pmod(F.xxhash64(*self.tables[name].keys), F.lit(self.buckets)).cast("int")

    def _part(self, name: str, folder: str, only: list[int] | None = None) -> DataFrame:
        schema = T.StructType([*self.tables[name].schema.fields, T.StructField("_gone", T.BooleanType()), T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{name}/{folder}")
        return (rows if only is None else rows.where(F.col("bucket").isin(only))).drop("bucket")

    def _folded(self, name: str, parts: list, only: list[int] | None = None) -> DataFrame:
        """Each key's row of the last part that has it; removed keys stay marked."""
        keys = self.tables[name].keys
        rows, above = self._part(name, parts[-1]["folder"], only), parts[-1]["rows"]
        for part in reversed(parts[:-1]):
            newer = keyed(rows.select(*keys), above).alias("n")
            untouched = self._part(name, part["folder"], only).alias("o").join(newer, _same("o", "n", keys), "left_anti")
            rows, above = untouched.unionByName(rows), above + part["rows"]
        return rows

    def _merged(self, name: str, parts: list, only: list[int] | None = None) -> DataFrame:
        schema = self.tables[name].schema
        if not parts or only == []:
            return local_df(self.spark, [], schema)
        rows = self._folded(name, parts, only)
        return rows.where("not _gone").select(schema.names)

    def read(self, name: str, before: int | None = None, near: DataFrame | None = None) -> DataFrame:
        """Newest committed rows; with ``near``, a frame with the key columns, at least those whose key it holds."""
        newest = self._newest(before)
        if newest is None:
            return local_df(self.spark, [], self.tables[name].schema)
        only = None
        if near is not None:      # at most ``buckets`` numbers
            only = sorted(r[0] for r in near.select(self._bucket(name)).distinct().collect())
        return self._merged(name, newest["parts"].get(name) or [], only)

    # -- writing

    def _write(self, name: str, folder: str, rows: DataFrame) -> dict:
        out = rows.select(*self.tables[name].schema.names, F.coalesce("_gone", F.lit(False)).alias("_gone"), self._bucket(name).alias("bucket"))
        target = f"{self.path}/{name}/{folder}"
        # few files for each bucket; adaptive execution splits what is large
        counted = Observation()
        out.hint("rebalance", "bucket").observe(counted, F.count(F.lit(1)).alias("rows")).write.partitionBy("bucket").parquet(target)
        return {"folder": folder, "rows": counted.get["rows"]}

    def commit(self, upserts: dict[str, DataFrame | Callable[[], DataFrame]], version: int | None = None,
               totals: dict[str, int] | None = None, merge: bool = True) -> int:
        """Publish rows of some tables as a new version (or redo the given one).

        A row replaces the one of its key, or removes it where its column ``_gone`` is true. Keys of one frame are unique.
        """
        replay, newest = version is not None, self._newest(version)
        if version is None:
            version = 0 if newest is None else newest["version"] + 1
        attempt = f"{version}-{uuid.uuid4().hex}"
        parts = {n: [p.asDict() for p in (newest["parts"].get(n) or [])] if newest else [] for n in self.tables}
        for name, frame in upserts.items():
            rows = frame() if callable(frame) else frame
            if "_gone" not in rows.columns:
                rows = rows.withColumn("_gone", F.lit(False))
            part = self._write(name, attempt, rows)
            if part["rows"]:
                parts[name] = self._tiered(name, [*parts[name], part], attempt) if merge else [*parts[name], part]
        stated = {**((newest["totals"] if newest else None) or {}), **(totals or {})}
        row = local_df(self.spark, [(version, attempt, stated, parts)],
                       "version long, attempt string, totals map<string,long>, parts map<string,array<struct<folder:string,rows:bigint>>>")
        (row.select("version", "attempt", F.current_timestamp().alias("committed_at"), "totals", "parts")
         .coalesce(1).write.mode("overwrite" if replay else "error").json(f"{self.path}/commits/{version}"))
        if version >= self.keep:
            self.expire()
        return version

    def _tiered(self, name: str, parts: list[dict], attempt: str) -> list[dict]:
        """Newest parts merged until every part is at least twice as large as all newer ones together."""
        first, rows = len(parts) - 1, parts[-1]["rows"]
        while first and parts[first - 1]["rows"] < 2 * rows:
            first -= 1
            rows += parts[first]["rows"]
        if first == len(parts) - 1:
            return parts
        whole = self._folded(name, parts[first:])
        return [*parts[:first], self._write(name, f"{attempt}-merged", whole if first else whole.where("not _gone"))]

    def expire(self, keep: int | None = None) -> None:
        """Delete all but the newest commits, and parts that none of those names."""
        commits = self._commits()
        old, kept = commits[:-(keep or self.keep)], commits[-(keep or self.keep):]
        if not old:
            return
        used = {(n, p["folder"]) for c in kept for n, ps in c["parts"].items() for p in ps}
        unused = {(n, p["folder"]) for c in old for n, ps in c["parts"].items() for p in ps} - used
        for name in [f"commits/{c['version']}" for c in old] + [f"{n}/{f}" for n, f in sorted(unused)]:
            self._files(self.path).delete(self._path(f"{self.path}/{name}"), True)


class MergedTable:
    """One table of a store (its only one unless ``store`` is given)."""

    def __init__(self, spark: SparkSession, path: str, table: Keyed, store: MergedStore | None = None, name: str = "rows"):
        self.name = name
        self.store = MergedStore(spark, path, {name: table}) if store is None else store

    def version(self, before: int | None = None) -> int | None:
        return self.store.version(before)

    def read(self, before: int | None = None, near: DataFrame | None = None) -> DataFrame:
        return self.store.read(self.name, before, near)

    def upsert(self, rows: DataFrame, version: int | None = None, merge: bool = True) -> int:
        return self.store.commit({self.name: rows}, version, merge=merge)
