"""Long pieces, tokens of any rank, and what the encoder leaves behind in the session."""

import random

import public_tokenizers
import pytest
import tiktoken

from tierwarden.llm import byte_bpe


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def folded(spark, bpe, pieces):
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(pieces)], "i int, piece string").repartition(8)
    return {r["i"]: r["ids"] for r in bpe.folded(frame, "piece", "ids").collect()}


def test_long_pieces(spark, ranks, monkeypatch):
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(8)
    letters = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    pieces = ["a" * 100_000, letters(100_000, "abcdefghijklmnopqrstuvwxyz"), letters(3000, "éüñ日本"), "the" * 1000, " " * 2001,
              letters(513, "etaoin"), letters(512, "etaoin"), "=-" * 700, letters(2000, "aab")]
    bpe = byte_bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    assert bpe.in_order
    got = folded(spark, bpe, pieces)
    for i, p in enumerate(pieces):
        assert got[i] == plain._encode_single_piece(p), i
    # both ways of folding agree
    short = [p[:400] for p in pieces] + [letters(300, "tha e") for _ in range(20)]
    monkeypatch.setattr(byte_bpe, "LONG", 1)
    assert folded(spark, bpe, short) == {i: plain._encode_single_piece(p) for i, p in enumerate(short)}


def test_ranks_beyond_the_surrogates(spark):
    """Characters of tokens skip the surrogates; tokens may be made of later ones, then steps are used throughout."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 55_039, b"cd": 55_040, b"abcd": 60_000, b"xy": 70_000, b"xyz": 65_536, b"zz": 1_000_000}
    plain = tiktoken.Encoding("plain", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    bpe = byte_bpe.ByteBpe(ranks, r"\S+|\s+")
    assert not bpe.in_order
    pieces = ["abcd", "xyz", "zzz", "abcdabxyzcd" * 60]
    assert folded(spark, bpe, pieces) == {i: plain._encode_single_piece(p) for i, p in enumerate(pieces)}


def test_rules_stand_in_the_plan_once(spark, ranks):
    """One projection with the subquery in it: the rules are no column of the rows, and the plan's text is short."""
    bpe = byte_bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    df = spark.createDataFrame([(1, ["two", "words"])], "i int, others array<string>").repartition(2)
    plan = bpe.folded(df, "others", "ids", many=True)._jdf.queryExecution().executedPlan().toString()
    assert "Subquery subquery#" in plan and byte_bpe.RULES not in plan and len(plan) < 20_000


def test_session_settings_stay(spark, ranks):
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch"]
    before = [spark.conf.get(k, None) for k in keys]
    bpe = byte_bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    df = spark.createDataFrame([(1, "two words"), (2, None)], "doc_id long, text string")
    assert [len(r["ids"]) for r in bpe.encode(df).orderBy("doc_id").collect()] == [2, 0]
    assert [spark.conf.get(k, None) for k in keys] == before
