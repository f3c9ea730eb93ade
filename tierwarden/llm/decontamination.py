"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle set (powers of two). All items of a partition
with upper size u get a MinHash sketch of their k = u - ceil(t * u) + 1 least hashes under one
permutation, k being enough for containment t: a document that holds at least t of an item of n
shingles misses at most n - ceil(t * n) of them, so it holds one of the sketch. Candidates are
documents with a shingle of the sketch; containment is then counted exactly on the full sets.

Documents keep only shingles that pass a bit map of the items' shingles. The map has a fixed size
(2 MB), whatever the items' number; a fuller map lets more rows pass and changes no result. All joins
are equi-joins on shingles or items, so items need not fit into memory.

Words are runs of letters, digits and non-ASCII characters in lower case. A shingle is ``width``
words; an item of fewer words is one shingle of all its words, looked for in runs of as many words.
Defined results: null or wordless items and texts match nothing; repeated items and repeated rows of
an id count once; null ids match nothing. One row for each (doc_id, item_id) found, however many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwarden.llm.shingles import shingle_hashes
from tierwarden.llm.storage import stored

BITS = 1 << 24
_SPLIT = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPLIT).split()


def _salted(found: np.ndarray, width: int) -> np.ndarray:
    """Runs of different widths never meet."""
    return found ^ np.uint64(width * 0x9E3779B97F4A7C15 & (1 << 64) - 1)


def item_shingles(items: DataFrame, width: int, text: str, item_id: str) -> DataFrame:
    """item_id, the width of its runs, its shingles."""
    def each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for i, x in zip(part["item_id"], part["text"], strict=True):
                w = words(x)
                if w:
                    n = min(width, len(w))
                    out.append((i, n, np.unique(_salted(shingle_hashes(w, n), n)).view(np.int64)))
            yield pd.DataFrame(out, columns=["item_id", "width", "shingles"])

    return (items.filter(F.col(item_id).isNotNull())
            .select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")).distinct()
            .mapInPandas(each, "item_id long, width int, shingles array<long>"))


def sketches(shingled: DataFrame, threshold: float) -> DataFrame:
    """(item_id, shingle): the least hashes of each item, as many as its size partition asks for."""
    size = F.size("shingles")
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(size.cast("double")))).cast("int")
    k = upper - F.ceil(upper * F.lit(threshold)).cast("int") + 1
    ranked = F.array_sort(F.transform("shingles", lambda x: F.struct(F.xxhash64(x).alias("rank"), x.alias("shingle"))))
    return shingled.select("item_id", F.explode(F.slice(ranked, 1, k)).alias("s")).select("item_id", "s.shingle")


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.8, width: int = 5, text: str = "text",
                 doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment (n_shared / n_item >= threshold)."""
    shingled = stored(item_shingles(items, width, text, item_id), "items")
    widths = sorted(r[0] for r in shingled.select("width").distinct().collect())     # at most ``width`` values
    bits = np.zeros(BITS, bool)
    slots = shingled.select(F.explode("shingles").alias("s")).select((F.col("s").bitwiseAND(BITS - 1)).cast("int").alias("s")).distinct()
    packed = slots.select((F.col("s") / 8).cast("int").alias("byte"), F.expr("shiftleft(1, s % 8)").alias("bit"))
    for r in packed.groupBy("byte").agg(F.bit_or("bit").alias("bits")).toLocalIterator():   # at most BITS / 8 rows
        bits[r["byte"] * 8:r["byte"] * 8 + 8] = [r["bits"] >> i & 1 for i in range(8)]
    shared_bits = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = np.unpackbits(shared_bits.value).view(bool)
        for part in parts:
            out = []
            for i, x in zip(part["doc_id"], part["text"], strict=True):
                w = words(x)
                found = [_salted(shingle_hashes(w, n, short=False), n) for n in widths]
                found = [f[known[(f & np.uint64(BITS - 1)).astype(np.int64)]] for f in found]
                hits = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)
                if len(hits):
                    out.append((i, hits.view(np.int64)))
            yield pd.DataFrame(out, columns=["doc_id", "hits"])

    source = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"),
                                                           F.col(text).cast("string").alias("text"))
    hits = stored(source.mapInPandas(each, "doc_id long, hits array<long>"), "hits")
    found = (hits.select("doc_id", F.explode("hits").alias("shingle"))
             .join(sketches(shingled, threshold), "shingle").select("doc_id", "item_id").distinct())
    pairs = found.join(hits, "doc_id")
    of_item = shingled.select("item_id", F.col("shingles").alias("of_item"))
    n_shared, n_item = F.size(F.array_intersect("hits", "of_item")), F.size("of_item")
    return (pairs.join(of_item, "item_id")
            .select("doc_id", "item_id", n_shared.cast("long").alias("n_shared"), n_item.cast("long").alias("n_item"))
            .filter(F.col("n_shared") >= threshold * F.col("n_item"))
            .groupBy("doc_id", "item_id").agg(F.max("n_shared").alias("n_shared"), F.max("n_item").alias("n_item"))
            .withColumn("containment", F.col("n_shared") / F.col("n_item")))


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = 0.8, width: int = 5, text: str = "text",
                  doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """``docs`` without the documents that hold an item."""
    bad = contaminated(docs, items, threshold, width, text, doc_id, item_id).select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, F.col(doc_id).cast("long") == F.col("__bad"), "left_anti")
