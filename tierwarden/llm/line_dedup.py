"""Repeated lines, found with levelled sorted runs of line hashes.

``LineRuns`` keeps, under the shared folder, runs sorted by a 128-bit line hash: (key, n_docs, keeper),
keeper being the largest document id that holds the line. A new batch of documents is reduced to
its own keys, merge-anti-joined with the runs - keys that are settled there (seen in ``min_docs``
documents with a keeper at least as large) need no further row - and the rest becomes a run of level 0.
When ``fanout`` runs of a level exist they are compacted into one sorted run of the next level.
Batches go from large ids to small ones, so common lines settle early and later runs stay small; any
other order gives the same result.

A line's key is the line without ASCII white space at both ends and with A-Z in lower case. Keys of
``min_chars`` code points or more found in ``min_docs`` documents or more lose all their lines but
those of the keeper. Hot lines are combined before each shuffle; joins are plain equi-joins whose
larger side adaptive execution may split.

Defined results: a null or empty text is one empty line and stays; a null id counts as the smallest
document; rows that repeat an id count as one document, and each keeps its row; other columns are
kept, ``n_lines`` and ``n_dropped`` replace columns of those names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwarden.llm.shingles import LOWER
from tierwarden.llm.storage import stored
from tierwarden.operators.durable import scratch_path

BLANK = b" \t\n\x0b\x0c\r"
NO_ID = -(2**63)


def line_keys(text: str | None, min_chars: int) -> list[bytes | None]:
    """A hash for every line that may be dropped, None for the others."""
    out: list[bytes | None] = []
    for line in (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split(b"\n"):
        line = line.strip(BLANK)
        long = len(line) >= min_chars and (len(line) >= 4 * min_chars or len(line.decode("utf-8", "surrogatepass")) >= min_chars)
        out.append(hashlib.blake2b(line, digest_size=16).digest() if long else None)
    return out


class LineRuns:
    SCHEMA = "key binary, n_docs long, keeper long"

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 3):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[str]] = [[]]

    def read(self) -> DataFrame:
        """Rows of all runs; a key may have one in each."""
        paths = [p for level in self.levels for p in level]
        return (self.spark.read.schema(self.SCHEMA).parquet(*paths) if paths
                else self.spark.createDataFrame([], self.SCHEMA))

    @staticmethod
    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def _write(self, rows: DataFrame, level: int) -> None:
        path = scratch_path(self.spark, f"lines-{level}")
        rows.sortWithinPartitions("key").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def add(self, lines: DataFrame) -> None:
        """``lines``: distinct (id, key) of documents that no earlier batch held."""
        own = lines.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("id").alias("keeper"))
        if any(self.levels):
            settled = self.totals(self.read()).filter(F.col("n_docs") >= self.min_docs)
            b, r = own.alias("b"), settled.alias("r")
            own = b.join(r, (F.col("b.key") == F.col("r.key")) & (F.col("r.keeper") >= F.col("b.keeper")), "left_anti")
        self._write(own, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self.totals(self.spark.read.schema(self.SCHEMA).parquet(*self.levels[level]))
            self._write(merged, level + 1)
            self.levels[level] = []
            level += 1

    def repeated(self) -> DataFrame:
        """(key, keeper) of keys in ``min_docs`` documents or more."""
        return self.totals(self.read()).filter(F.col("n_docs") >= self.min_docs).select("key", "keeper")


def dedup_lines(df: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 3,
                text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``df`` with repeated lines taken out of ``text``, and ``n_lines`` (before), ``n_dropped``."""
    def keyed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [(i, k) for i, x in zip(part["id"], part["text"], strict=True) for k in set(line_keys(x, min_chars)) if k]
            yield pd.DataFrame(found, columns=["id", "key"])

    row_id = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))
    source = df.select(row_id.alias("id"), F.col(text).cast("string").alias("text"))
    lines = stored(source.mapInPandas(keyed, "id long, key binary").distinct(), "lines")
    ends = lines.agg(F.min("id"), F.max("id")).first()
    runs = LineRuns(df.sparkSession, min_docs, fanout)
    if ends[0] is not None:
        least, step = ends[0], (ends[1] - ends[0]) // batches + 1
        for n in reversed(range(batches)):
            runs.add(lines.filter((F.col("id") >= least + n * step) & (F.col("id") <= min(ends[1], least + (n + 1) * step - 1))))
    lost = (lines.join(runs.repeated(), "key").filter("id <> keeper")
            .groupBy("id").agg(F.collect_list("key").alias("lost")))

    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, drops in parts:
            out = []
            for x, drop in zip(texts, drops, strict=True):
                whole = x or ""
                if drop is None:
                    out.append((whole, whole.count("\n") + 1, 0))
                    continue
                gone = set(drop)
                kept = [s for s, k in zip(whole.split("\n"), line_keys(whole, min_chars), strict=True) if k not in gone]
                n = whole.count("\n") + 1
                out.append(("\n".join(kept), n, n - len(kept)))
            yield pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])

    names = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    joined = df.select(*names, row_id.alias("__id")).join(lost.withColumnRenamed("id", "__id"), "__id", "left")
    done = joined.withColumn("__cut", cut(F.col(text).cast("string"), F.col("lost")))
    return done.select(*[F.col("__cut.text").alias(text) if c == text else F.col(c) for c in names],
                       F.col("__cut.n_lines").alias("n_lines"), F.col("__cut.n_dropped").alias("n_dropped"))
