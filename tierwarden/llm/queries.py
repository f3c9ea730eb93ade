"""The registered queries of this subpackage and their SQL, and the pipeline."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tierwarden.llm import (byte_bpe, chat, circulant_minhash, decontamination, embedding_dedup, hard_negatives, line_dedup, periodic_runs, quality,
                            quality_rules, toxicity, url_filter, warc)
from tierwarden.llm.labels import held_out
from tierwarden.llm.oracles import SQL  # noqa: F401
from tierwarden.operators.durable import scratch_path

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    done = chat.format_chats(rows.withColumn("parts", chat.text_part(F.col("text"))))

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string")
    def digests(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, spans in parts:
            out = []
            for text, loss in zip(texts, spans, strict=True):
                turns = chat.read_back(text)
                learned = chat.loss_text(text, [(s["start"], s["stop"]) for s in loss])
                out.append((len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                            len(learned), hashlib.sha256(learned.encode()).hexdigest()))
            yield pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256"])

    return (done.select("conv_id", digests("formatted", "loss").alias("d"), F.length("formatted").cast("long").alias("formatted_chars"))
            .select("conv_id", "d.*", "formatted_chars"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return (url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), rules)
            .select("page_id", "host", "path", "rule", "verdict"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return (warc.read_archives(spark, path, payloads=False)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(_table(spark, sf_dir, "embeddings"), least=0.93)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=20, min_docs=3)
            .select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return _predictions(toxicity.scored(docs, model), 0.5)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    decode = bpe.decoder()

    def digests(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = [x.values.to_numpy() for x in batch.column("ids")]
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_tokens": pa.array([len(x) for x in lists], pa.int64()),
            "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in lists],
            "decoded_sha256": [hashlib.sha256(decode(x.tolist())).hexdigest() for x in lists]})

    return bpe.encode(docs, "text", keep=["doc_id"], then=(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return _predictions(quality.scored(docs, model), 0.3)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (_table(spark, sf_dir, "embeddings")
            .withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))
    return hard_negatives.mined(rows, anchors=F.col("vec_id") % 50 == 0, scale=256, positives=5, negatives=3, low=50, high=95)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    top = periodic_runs.longest("runs")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return (periodic_runs.runs_of(docs, least=12, spread=periodic_runs.planted)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"),
                    F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).alias("lines"), "collapsed")
            .select("doc_id", "n_runs", "top.start", "top.length", "top.period",
                    F.floor(F.col("top.length") * 1000 / F.col("top.period")).alias("exponent_milli"),
                    F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))      # a fifth is left to measure the guarantee on
    return (quality_rules.judged(_table(spark, sf_dir, "documents"), labels)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))


def _predictions(scored: DataFrame, least: float) -> DataFrame:
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= least).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_chat_formatting, op2_url_filters, op3_warc, op4_embedding_near_dedup, op5_line_dedup,
                            op6_minhash_near_dedup, op7_toxicity, op8_byte_bpe, op9_decontamination, op10_quality,
                            op11_hard_negatives, op12_periodic_runs, op13_quality_rules)
} | {"pipeline": corpus_pipeline.run}
