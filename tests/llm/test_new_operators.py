"""Hard negatives, periodic runs and quality rules: against plain versions, and on odd input."""

import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierwarden.llm import hard_negatives, periodic_runs, quality_rules
from tierwarden.llm.labels import held_out

# ---- periodic runs


def plain_runs(w, least=12):
    """Every period, every stretch; the smallest period of a stretch wins."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        start = 0
        while start < len(w) - q:
            if w[start] != w[start + q]:
                start += 1
                continue
            stop = start
            while stop < len(w) - q and w[stop] == w[stop + q]:
                stop += 1
            length = stop - start + q
            smaller = any(all(w[k] == w[k + r] for k in range(start, start + length - r)) for r in range(1, q))
            if length >= max(least, 2 * q) and not smaller:
                out.append((start, length, q))
            start = stop
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 6)), max_size=5), st.sampled_from([2, 5, 12]))
def test_runs_against_brute_force(parts, least):
    w = [x for word, times in parts for x in word * times][:90]
    ids = np.unique(np.array(w, np.int64), return_inverse=True)[1] if w else np.empty(0, np.int64)
    assert periodic_runs.find_runs(ids, least) == plain_runs(w, least)


def test_runs_of_long_and_famous_words():
    assert periodic_runs.find_runs(np.zeros(50000, np.int64)) == [(0, 50000, 1)]
    assert periodic_runs.find_runs(np.arange(30000) % 9000) == [(0, 30000, 9000)]
    thue = [bin(i).count("1") % 2 for i in range(300)]
    fib, last = [0, 1], [0]
    while len(fib) < 200:
        fib, last = fib + last, fib
    for w in (thue, fib[:200]):
        assert periodic_runs.find_runs(np.array(w)) == plain_runs(w)


def test_run_query_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 80)))) for i in range(60)]
    rows += [(i, "\n".join(f"w{k % (i % 50 + 1)}" for k in range(120))) for i in range(100, 160)]
    rows += [(200, None), (201, ""), (202, " \t\r\n"), (None, "x " * 40), (100, rows[60][1]), (203, "é é é é " * 12), (204, "solo")]
    monkeypatch.setattr(periodic_runs, "BYTES", 300)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, runs int, collapsed int")
    for spread in (None, periodic_runs.planted):
        got = periodic_runs.runs_of(df, spread=spread).collect()
        assert len(got) == len(rows)
        want = {}
        for i, t in rows:
            w = (t or "").encode().split()
            h = zlib.crc32(str(i).encode())
            if spread and i is not None and h % 10 == 0 and w:
                g = h // 10
                a = g % len(w)
                p = 1 + (len(w) - a) // (3 + g % 8)
                w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
            runs = plain_runs(w)
            want[i] = (runs, plain_collapse([x.decode() for x in w], runs))
        for r in got:
            assert ([(x["start"], x["length"], x["period"]) for x in r["runs"]], r["collapsed"]) == want[r["doc_id"]], r["doc_id"]
    assert periodic_runs.runs_of(df.limit(0)).count() == 0
    top = df.limit(1).selectExpr("array(named_struct('start', 5L, 'length', 20L, 'period', 2L), named_struct('start', 1L, 'length', 20L, 'period', 4L), "
                                 "named_struct('start', 1L, 'length', 20L, 'period', 3L)) AS runs").select(periodic_runs.longest()).first()[0]
    assert (top["start"], top["period"]) == (1, 3)


# ---- hard negatives

def plain_negatives(rows, scale=256, low=50, high=95):
    """[(id, label, vector)] -> the returned rows."""
    by = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            e = [math.floor(scale * x) for x in v]
            by[i] = min(by.get(i, (str(label), v, e)), (str(label), v, e))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for a, (label, _, v) in by.items():
        if a % 5:
            continue
        ranked = sorted((-dot(v, e), i, other) for i, (other, _, e) in by.items() if i != a)
        for s, p, _ in [x for x in ranked if x[2] == label][:5]:
            fit = [x for x in ranked if x[2] != label and low * -s <= 100 * -x[0] <= high * -s]
            out += [(a, p, k, n, -s, -x) for k, (x, n, _) in enumerate(fit[:3], 1)]
    return sorted(out)


@pytest.mark.parametrize("block, together, scale", [(4096, 64, 256), (9, 2, 256), (16, 3, 2**26)])
def test_negatives_against_brute_force(spark, monkeypatch, block, together, scale):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "TOGETHER", together)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12))
    rows = [(i, int(rng.integers(0, 3)), (centres[i % 6] * rng.choice([1, 3]) + rng.normal(size=12) * rng.choice([0.01, 0.3, 1])).tolist()) for i in range(150)]
    rows += [(200 + i, i % 2, rows[3][2]) for i in range(40)]      # ties
    rows += [(300, None, rows[0][2]), (305, 1, None), (310, 1, [None] * 12), (315, 1, [float("nan")] * 12), (320, 2, [float("inf")] + [0.0] * 11),
             (325, 1, [0.0] * 12), (330, 0, [0.0] * 12), (335, 1, []), (340, 2, [1.0, 2.0]), (345, 2, [0.5] * 15), (None, 1, rows[0][2]), (0, rows[0][1], rows[0][2]),
             (350, 9, rows[1][2])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, rank int, near string")
    got = hard_negatives.mined(df, df["vec_id"] % 5 == 0, scale=scale).collect()
    assert sorted(tuple(r) for r in got) == plain_negatives(rows, scale)
    assert len(got) > 100
    assert hard_negatives.mined(df.limit(0), df["vec_id"] % 5 == 0).count() == 0
    assert hard_negatives.mined(df.filter("label = 1"), df["vec_id"] % 5 == 0).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([2, 5, 30]), st.sampled_from([1.0, 1e-3, 300.0]))
def test_scores_lie_within_their_bounds(seed, width, spread):
    rng = np.random.default_rng(seed)
    a, b = (np.floor(256 * spread * rng.normal(size=(12, width))) for _ in range(2))
    b[:4] = a[:4] * rng.integers(-2, 3, size=(4, 1))
    towards = hard_negatives.directions([*a.tolist(), *b.tolist()])
    (na, ta), (nb, tb) = (hard_negatives._measured(x, towards) for x in (a, b))
    lower, upper = hard_negatives.bounds_of(ta.astype("<f4"), na, tb.astype("<f4"), nb)
    scores = hard_negatives.scores_of(a, b)
    assert (scores == np.array([[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a])).all()
    assert (lower <= scores).all() and (scores <= upper).all()


# ---- quality rules

def plain_counts(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)}
    return (len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again), len(lines))


def test_counts_against_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", " \t", "a b", "a b c", "a b c a b c", "x x x x x", "é é é 😀 #*$%&|<>", "a\n\na\n a\na", "one\r\ntwo\r\none\r\n", "\n\n \n\t"]
    texts += [" ".join(rng.choice("abcd") + rng.choice(["", "#", "\n", "\x0b"]) for _ in range(rng.randrange(0, 60))) for _ in range(60)]
    texts += ["longer words in a long text " * 3000]
    df = spark.createDataFrame([(i, t, "en", 7) for i, t in enumerate(texts[:-1])], "doc_id int, text string, lang string, n_words int")
    got = quality_rules.counted(df, "text", df["doc_id"]).collect()
    assert {r["doc_id"]: tuple(r[c] for c in quality_rules.COUNTS) for r in got} == {i: plain_counts(t) for i, t in enumerate(texts[:-1])}
    long = quality_rules.counted(spark.createDataFrame([(texts[-1],)], "text string"), "text").first()
    assert (long["n_words"], long["n_repeat_words"]) == (18000, 18000)


def test_binomial_limit(spark):
    from pyspark.sql import functions as F
    cases = [(n, d) for n in (0, 1, 50, 99, 300, 1500, 20000) for d in (0.05, 0.0025, 1e-6)]
    df = spark.createDataFrame(cases, "n long, doubt double")
    for r in df.withColumn("k", quality_rules.most_rejections(F.col("n"), 0.01, F.col("doubt"))).collect():
        log = lambda i: math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(0.01) + (r.n - i) * math.log(0.99)  # noqa: E731, B023
        below, k = 0.0, -1
        for i in range(r.n + 1):
            below += math.exp(log(i))
            if below > r.doubt:
                break
            k = i
        assert r.k == k, r


def test_rules_keep_their_promise(spark):
    """Strata of different habits: each learns its own cutoff, good rows are spared, a small stratum learns nothing."""
    rng = random.Random(6)

    def text(symbols, n=60):
        return " ".join(f"word{rng.randrange(10**6)}" + ("#" if rng.random() < symbols else "") for _ in range(n))
    rows, labels = [], []
    for i in range(9000):
        lang = ("plain", "code", None)[i % 3] if i % 300 else "few"
        good = rng.random() < 0.7
        share = {"plain": 0.01 if good else 0.3, "code": 0.4 if good else 0.9}.get(lang, 0.02 if good else 0.5)
        rows.append((i, text(share), lang))
        labels.append((i, int(good)))
    df = spark.createDataFrame([(*r, "x") for r in rows] + [(None, None, None, "x"), (10**6, "too short", "plain", "x"), (5, text(0.01), "plain", "x")],
                               "doc_id long, text string, lang string, failed string").repartition(8)
    known = spark.createDataFrame([*labels, (None, 1), (7, None), (8, 1), (8, 0)], "doc_id long, quality int")
    out = quality_rules.judged(df, known.filter(~held_out(known["doc_id"])), false_rejection=0.05).collect()
    assert len(out) == len(rows) + 3
    truth, of = dict(labels), {r[0]: r[2] for r in rows}
    for lang in ("plain", "code", None):
        mine = [r for r in out if r["doc_id"] in truth and of[r["doc_id"]] == lang and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
        wrong = np.mean([not r["kept"] for r in mine if truth[r["doc_id"]]])
        caught = np.mean([not r["kept"] for r in mine if not truth[r["doc_id"]]])
        assert wrong <= 0.05 and caught >= 0.9, (lang, wrong, caught)
    assert all(r["kept"] for r in out if r["doc_id"] in of and of[r["doc_id"]] == "few")
    assert [r["kept"] for r in out if r["doc_id"] in (None, 10**6)] == [False, False]
    none = quality_rules.judged(df, known.limit(0))
    assert none.filter("kept = base_failed").count() == 0
    assert quality_rules.judged(df.limit(0), known).count() == 0


def test_rules_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a b c", "en")], "doc_id long, text string, lang string")
    plan = quality_rules.counted(df, "text", df["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

