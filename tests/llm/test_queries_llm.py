"""The registered queries over whole tables: against SQL, against plain versions, or by held-out accuracy."""

import hashlib
import os

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from brute import contained, lines, near_documents, sha
from tierwarden.llm import byte_bpe, queries, toxicity

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    got = table([tuple(r) for r in df.collect()], df.columns)
    cur = duck.execute(queries.SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == table(cur.fetchall(), columns)


def test_all_queries_and_stages():
    assert [f"op{n}" for n in range(1, 14)] + ["pipeline"] == [q.split("_")[0] for q in queries.QUERIES]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "minhash_near_dedup", "decontamination", "byte_bpe"]


@pytest.mark.parametrize("name, label, least", [("op7_toxicity", "toxic", 0.9), ("op10_quality", "quality", 0.9)])
def test_held_out_accuracy(spark, duck, name, label, least):
    sf = "/root/testdata/sf0.01"
    truth = dict(duck.execute(f"SELECT doc_id, {label} FROM '{sf}/labels.parquet'").fetchall())
    rows = queries.QUERIES[name](spark, sf).collect()
    assert len(rows) == duck.execute(f"SELECT count(*) FROM '{sf}/documents.parquet'").fetchone()[0]
    assert all(0 <= r["score"] <= 1 for r in rows)
    tested = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in tested]) >= least


@pytest.fixture(scope="module")
def encoding():
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_query(spark, duck, encoding):
    texts = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    rows = queries.QUERIES["op8_byte_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = encoding.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == sha(texts[r["doc_id"]] or "")


def test_pipeline_against_plain_version(spark, duck, encoding):
    """Every stage, worked out on the rows its predecessor kept; the classifier's decisions come from its model."""
    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    docs = [(i, t) for i, t in docs if model.score(t) < 0.5]
    docs = [(i, t) for i, (_, _, t) in lines(docs).items()]
    near = near_documents(docs, 5, 80)
    docs = [(i, t) for i, t in docs if near[i][1] == i]
    bad = {i for i, _ in contained(docs, duck.execute("SELECT item_id, text FROM benchmark").fetchall())}
    want = {i: encoding.encode_ordinary(t) for i, t in docs if i not in bad}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == want
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() > 0
