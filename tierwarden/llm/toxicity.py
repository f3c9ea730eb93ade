"""Toxicity: a factorization machine over hashed terms.

A document is the set of its hashed terms: every distinct lower-case word and its first bytes, for
each length of ``PREFIXES``, so that inflected forms share a term. The score is sigmoid(w0 + sum w_i + sum_{i<j} <v_i, v_j>); the factors v let two
terms that are harmless alone, such as an insult and the name of a group, count together, which
additive weights miss. Terms found in fewer than ``min_df`` training rows take no part.

Training is numpy Adagrad on a documented, bounded sample: at most ``per_class`` labelled rows of
either class (``labels.training_rows``), whatever the input's size. Scoring is one narrow pass over
all rows; the model (a few MB, bounded by the hash size) is broadcast.

Defined results: a null or empty text has no term and scores sigmoid(w0); without rows of both
classes nothing is learned and every score is the share of label 1 (0 without labels).
Other columns are kept; ``score`` replaces a column of that name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwarden.llm.labels import fitted, training_rows
from tierwarden.llm.shingles import bounds, run_hashes

HASH_BITS, FACTORS, PREFIXES = 20, 6, (4, 5)
_SPLIT = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> np.ndarray:
    """Distinct hashed terms of a text."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPLIT).split()
    if not words:
        return np.empty(0, np.int32)
    starts, ends = bounds(words)
    data = b" ".join(words)
    whole = run_hashes(data, starts, ends)
    fronts = [~run_hashes(data, starts, np.minimum(ends, starts + n)) for n in PREFIXES]
    return np.unique((np.concatenate((whole, *fronts)) >> np.uint64(64 - HASH_BITS)).astype(np.int32))


@dataclass
class FactorizationMachine:
    slots: np.ndarray          # hashed term -> feature, or 0: a feature of zeros
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, text: str | None) -> float:
        x = self.slots[terms(text)]
        v = self.factors[x]
        total = v.sum(axis=0)
        z = self.bias + self.weights[x].sum() + 0.5 * float(total @ total - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[np.ndarray, int]], min_df: int = 5, epochs: int = 16, rate: float = 0.4, sparse: float = 0.5, decay: float = 1.0,
        start: float = 30.0, seed: int = 3) -> FactorizationMachine:
    """Adagrad on the logistic loss in batches of 64 rows; both classes weigh the same.

    ``start`` keeps terms with small gradients slow, and ``sparse`` pulls every weight (and ``decay``
    every factor) towards zero, so that the many terms of a long harmless text do not add up.
    """
    y = np.array([r[1] for r in rows], np.float32)
    slots = np.zeros(1 << HASH_BITS, np.int32)
    share = float(y.mean()) if len(y) else 0.0
    if share in (0.0, 1.0):
        bias = 30.0 if share else -30.0
        return FactorizationMachine(slots, bias, np.zeros(1, np.float32), np.zeros((1, FACTORS), np.float32))
    df = np.zeros(1 << HASH_BITS, np.int32)
    for x, _ in rows:
        df[x] += 1
    used = np.flatnonzero(df >= min_df)
    slots[used] = np.arange(1, len(used) + 1)
    rng = np.random.default_rng(seed)
    w = np.zeros(len(used) + 1, np.float32)
    v = rng.normal(0, 0.05, (len(used) + 1, FACTORS)).astype(np.float32)
    v[0] = 0
    gw, gv, bias, gb = np.full(len(w), start, np.float32), np.full(v.shape, start, np.float32), 0.0, start
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    features = [f[f > 0] for f in (slots[x] for x, _ in rows)]
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            pick = [i for i in order[at:at + 64] if len(features[i])]
            if not pick:
                continue
            sizes = np.array([len(features[i]) for i in pick])
            x, of = np.concatenate([features[i] for i in pick]), np.repeat(np.arange(len(pick)), sizes)
            begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            vx = v[x]
            total = np.add.reduceat(vx, begin)
            z = bias + np.add.reduceat(w[x], begin) + 0.5 * ((total**2).sum(1) - np.add.reduceat((vx**2).sum(1), begin))
            err = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) * weight[pick]).astype(np.float32)
            slope = err[of]
            seen, back = np.unique(x, return_inverse=True)
            dw = np.bincount(back, slope, len(seen)).astype(np.float32)
            dv = np.zeros((len(seen), FACTORS), np.float32)
            inner = (total[of] - vx) * slope[:, None] / np.sqrt(sizes)[of][:, None]
            for k in range(FACTORS):
                dv[:, k] = np.bincount(back, inner[:, k], len(seen))
            gw[seen] += dw**2
            gv[seen] += dv**2
            pace = rate / np.sqrt(gw[seen])
            moved = w[seen] - pace * dw
            w[seen] = np.sign(moved) * np.maximum(0, np.abs(moved) - pace * sparse)
            v[seen] -= rate * (dv + decay * v[seen]) / np.sqrt(gv[seen])
            gb += float(err.sum()) ** 2
            bias -= rate * float(err.sum()) / gb**0.5
    return FactorizationMachine(slots, bias, w, v)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 4000, text: str = "text",
          doc_id: str = "doc_id") -> FactorizationMachine:
    """A model from at most ``2 * per_class`` rows."""
    @F.pandas_udf("binary")
    def hashed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: terms(x).tobytes())

    rows = training_rows(docs, labels, label, per_class, text, doc_id).select("id", "label", hashed("text").alias("x"))
    return fitted(rows, lambda r: fit([(np.frombuffer(x, np.int32), y) for x, y in zip(r["x"], r["label"], strict=True)]))


def scored(docs: DataFrame, model: FactorizationMachine, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` between 0 and 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield texts.map(shared.value.score, na_action=None).astype(float)

    return docs.withColumn("score", score(F.col(text).cast("string")))
