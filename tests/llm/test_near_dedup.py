"""Near-duplicates where buckets mix components, and hashes that structured words cannot defeat."""

import random

import numpy as np
import pytest

from brute import near_documents
from tierwarden.llm import circulant_minhash, decontamination, shingles


def thue_morse(n=1024):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_structured_words_stay_apart(spark):
    x, y = thue_morse()
    texts = [x, y, f"x {x} y z", f"x {y} y z", f"{x} {y}", f"{y} {x}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["component_id"] for r in circulant_minhash.near_duplicates(df, width=3, percent=85).collect()}
    assert out == {i: i for i in range(len(texts))}
    items = spark.createDataFrame([(7, f"p {x} q r s"), (8, x)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"p {y} q r s"), (2, f"p {x} q r s"), (3, y)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, items).collect()) == [(2, 7), (2, 8)]
    found = shingles.shingle_hashes([w.encode() for w in (x, y, x, x, y)], 2)
    assert len(np.unique(found)) == 3


@pytest.mark.parametrize("paired, width, percent, seed", [(32, 3, 85, 1), (2, 3, 85, 2), (2, 5, 80, 3), (3, 2, 70, 4), (2, 1, 90, 5)])
def test_mixed_buckets_against_brute_force(spark, monkeypatch, paired, width, percent, seed):
    """Templates, templates of templates and near copies around the threshold: few bands, so that buckets mix them all."""
    monkeypatch.setattr(circulant_minhash, "PAIRED", paired)
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]

    def edited(text, share):
        out = [rng.choice(words) if rng.random() < share else w for w in text]
        if rng.random() < 0.3:
            out = out[:len(out) - rng.randrange(1, 8)]
        return out
    base = [[rng.choice(words) for _ in range(rng.choice([20, 60]))] for _ in range(3)]
    middle = [edited(rng.choice(base), 0.08) for _ in range(12)]
    rows = [edited(rng.choice(middle), rng.choice([0, 0.01, 0.03, 0.06])) for _ in range(150)]
    rows += [x + ["common", "line", "of", "many", "texts"] for x in rows[:40]]
    rows = [(i, " ".join(x)) for i, x in enumerate(base + middle + rows)]
    want = near_documents(rows, width, percent)
    # the more bands, the surer that linked documents meet
    got = circulant_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width, percent, bands=60, rows=3).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len({c for _, c in want.values()}) > 5


def test_members_without_a_partner_are_left_out(spark, monkeypatch):
    """Edits of one text, few of them linked: few members are joined on shared elements, and no group is left for another round."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    base = [rng.choice(words) for _ in range(200)]
    rows = [(i, " ".join(rng.choice(words) if rng.random() < share else w for w in base))
            for i, share in enumerate(rng.uniform(0, 0.1) for _ in range(500))]
    made, stored = {}, circulant_minhash.stored

    def counted(df, name):
        out = stored(df, name)
        made.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(circulant_minhash, "stored", counted)
    monkeypatch.setattr(circulant_minhash, "PAIRED", 16)
    got = circulant_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == near_documents(rows, 3, 85)
    assert made["elements"][0] > 100_000 and made["ranked"][0] < 4_000 and made["star"][1:] == [0], made


def test_partners_against_all_pairs(spark):
    rng = random.Random(3)
    both = 180
    rows = [(c, i, u, rng.randrange(-2000, 360 * u), rng.random() < 0.6) for c in range(4) for i in range(60 * c) for u in [rng.randrange(1, 150)]]
    got = {(r["centre"], r["doc_id"]): r for r in circulant_minhash.partnered(
        spark.createDataFrame(rows, "centre long, doc_id long, u long, w long, outside boolean"), "centre", both).collect()}
    left_out = 0
    for c, i, u, w, outside in rows:
        fit = [y for y in rows if y[0] == c and y[1] != i and 2 * both * min(u, y[2]) >= w + y[3] and (outside or y[4])]
        if fit:
            assert got[c, i]["least_w"] <= min(y[3] for y in fit)
            unlinked = [y[3] for y in fit if y[4]]
            assert not unlinked or got[c, i]["least_out"] <= min(unlinked)
        left_out += (c, i) not in got
    assert left_out and len(got) == len(rows) - left_out


def test_stages_on_odd_tables(spark):
    """Nulls, repeated rows, an empty table and clashing names pass every stage."""
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    schema = "doc_id long, text string, lang string, score double, component_id string, n_lines int"
    rows = [(1, None), (2, ""), (2, ""), (None, "no id " * 30), (3, "x " * 20000), (4, "a word\n" * 5), (4, "another text of the same id")]
    df = spark.createDataFrame([(*r, None, None, "y", None) for r in rows], schema)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    for docs in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns and out.count() <= docs.count()
            docs = out
        last = corpus_pipeline.tokenize(spark, docs, sf)
        assert last.filter("not round_trip").count() == 0 and last.count() == docs.count()
    assert spark.conf.get(key) == before
