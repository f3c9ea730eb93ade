"""The corpus pipeline: toxicity, line dedup, MinHash near-dedup, decontamination, byte-level BPE.

``run`` applies ``STAGES`` to documents. Each stage's rows are written as Parquet under the shared folder
and read back as the next one's input. All but the last return the columns of documents.

What a stage stores on its way is worked out with Arrow batches of at most ``BATCH`` texts, since a Python worker keeps the
memory that its largest batch took; the session's setting is then as it was.

Null and empty texts, repeated rows and null ids pass every stage as its operator's docstring says; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwarden.llm import byte_bpe, circulant_minhash, decontamination, line_dedup, toxicity
from tierwarden.llm.storage import stored


BATCH = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    with byte_bpe.settings(spark, {key: str(min(BATCH, int(spark.conf.get(key))))}):
        yield


def _columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``; the characters of a text are counted anew."""
    if "n_chars" in like.columns:
        df = df.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return df.select(*like.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a model fitted on the labels of the given documents."""
    with small_batches(spark):
        model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, model).filter("score < 0.5").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more found in three documents or more stay only in the one of the largest id."""
    with small_batches(spark):
        return _columns(line_dedup.dedup_lines(docs, min_chars=20, min_docs=3), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by five-word shingles at Jaccard 0.8 or more."""
    with small_batches(spark):
        extra = circulant_minhash.near_duplicates(docs, width=5, percent=80).filter("not kept").select("doc_id").distinct()
    return docs.join(extra, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than 0.8 of every benchmark item's five-word shingles."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    with small_batches(spark):
        return decontamination.decontaminate(docs, items).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every document, and whether they decode to its text."""
    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    decode = bpe.decoder()

    def checked(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = [x.values.to_numpy() for x in batch.column("ids")]
        same = [decode(x.tolist()) == (t or "").encode() for x, t in zip(lists, batch.column("text").to_pylist(), strict=True)]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_tokens": pa.array([len(x) for x in lists], pa.int64()),
                                           "ids": batch.column("ids"), "round_trip": pa.array(same, pa.bool_())})

    return bpe.encode(docs.select(F.col("doc_id").cast("long"), "text"), "text",
                      then=(checked, "doc_id long, n_tokens long, ids array<int>, round_trip boolean"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("minhash_near_dedup", drop_near_copies),
          ("decontamination", drop_benchmark), ("byte_bpe", tokenize)]

#: Toxicity, MinHash and BPE cannot be expressed in SQL; tests compare the pipeline with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
