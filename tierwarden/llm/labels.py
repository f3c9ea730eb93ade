"""Labelled rows for training: which rows may be learned from, and a bounded, balanced choice of them."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True for rows never learned from: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int, text: str = "text",
                  doc_id: str = "doc_id") -> DataFrame:
    """(label, text) of at most ``per_class`` labelled documents of either class, chosen by a hash of the id.

    An id labelled more than once takes its largest label; null ids and labels are left out.
    """
    known = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("label").alias("label")))
    present = docs.select(F.col(doc_id).alias("id")).distinct()
    known = known.join(present, "id", "left_semi")
    chosen = None
    for value in (0, 1):
        some = known.filter(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = some if chosen is None else chosen.union(some)
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    # at most 2 * per_class rows
    return source.join(F.broadcast(chosen), "id").dropDuplicates(["id"]).select("id", "label", "text")


def fitted(rows: DataFrame, fit: Callable[[pd.DataFrame], Any]) -> Any:
    """``fit`` of the bounded ``rows`` (id, label, features), in id order, in one task; only the model reaches the driver."""
    columns = rows.columns

    def one(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(parts)
        sample = pd.concat(frames).sort_values("id") if frames else pd.DataFrame(columns=columns)
        yield pd.DataFrame({"model": [pickle.dumps(fit(sample))]})

    found = rows.repartition(1).mapInPandas(one, "model binary").first()      # nothing runs on a plan known to be empty
    return fit(pd.DataFrame(columns=columns)) if found is None else pickle.loads(found["model"])
