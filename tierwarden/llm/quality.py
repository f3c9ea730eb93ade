"""Quality: supervised subword embeddings with a softmax output.

Features are hashed words and character n-grams of words with their boundaries; a word that repeats
the one before it counts as one common feature, whatever the word. A document is the
mean of its features' learned vectors, followed by a linear layer and softmax, both trained by numpy
stochastic gradient descent on a documented, bounded sample of labelled rows
(``labels.training_rows``: at most ``per_class`` of either class, whatever the input's size).

Scoring folds vectors and output layer into one number for each hash, so a whole text costs one
table look-up for each feature, in one narrow pass; the folded table (512 KB) is broadcast.

Defined results: a null or empty text has no feature and scores the softmax of the output biases;
without rows of both classes every score is the share of label 1 (0 without labels).
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

HASH_BITS, SIZE, GRAMS = 16, 10, (3, 4)
_ODD = np.uint32(0x9E3779B1)
REPEAT = np.uint32(0xFFFFFFFF)


def features(text: str | None) -> Iterator[np.ndarray]:
    """Hashes of the words, then of the n-grams for each n; repeated ones as often as they occur."""
    words = (text or "").split()
    if not words:
        return
    chars = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = np.flatnonzero(chars == 32)
    mixed = (chars + np.uint32(1)) * _ODD
    mixed ^= mixed >> np.uint32(15)
    place = np.arange(len(chars), dtype=np.uint32)
    sums = np.cumsum(mixed * (place * np.uint32(2) + np.uint32(1)), dtype=np.uint32)
    plain = np.cumsum(mixed, dtype=np.uint32)
    # sum of c_j * (2 (j - start) + 1), a hash of the word wherever it stands
    start, end = blank[:-1], blank[1:]
    word = (sums[end] - sums[start]) - (plain[end] - plain[start]) * (place[start] * np.uint32(2))
    word = (word * _ODD + (end - start).astype(np.uint32)) * np.uint32(0x85EBCA6B)
    word[1:][word[1:] == word[:-1]] = REPEAT
    yield word >> np.uint32(32 - HASH_BITS)
    inside = np.cumsum(chars == 32, dtype=np.int32)
    for n in GRAMS:
        if len(chars) < n:
            continue
        gram = mixed[:len(chars) - n + 1].copy()
        for i in range(1, n):
            gram *= np.uint32(0x01000193)
            gram += mixed[i:len(chars) - n + 1 + i]
        gram *= _ODD
        # at most the first and the last character are blanks: n-grams of one word with its boundaries
        one = inside[n - 2:len(chars) - 1] == inside[:len(chars) - n + 1]
        yield (gram ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF))[one] >> np.uint32(32 - HASH_BITS)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their share in the text."""
    parts = list(features(text))
    if not parts:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    found, n = np.unique(np.concatenate(parts).astype(np.int32), return_counts=True)
    return found, (n / n.sum()).astype(np.float32)


@dataclass
class SubwordClassifier:
    table: np.ndarray     # of each hash: its vector's part of the difference of the two outputs
    bias: float

    def score(self, text: str | None) -> float:
        total = n = 0
        for part in features(text):
            total += float(self.table[part].sum(dtype=np.float64))
            n += len(part)
        z = self.bias + (total / n if n else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, rate: float = 0.5, seed: int = 5) -> SubwordClassifier:
    """Stochastic gradient descent, one document at a time, with a falling rate; both classes weigh the same."""
    share = float(np.mean([r[2] for r in rows])) if rows else 0.0
    if share in (0.0, 1.0):
        return SubwordClassifier(np.zeros(1 << HASH_BITS, np.float32), 30.0 if share else -30.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (1 << HASH_BITS, SIZE)).astype(np.float32)
    out, bias = np.zeros((2, SIZE), np.float32), np.zeros(2, np.float32)
    weight = (0.5 / (1 - share), 0.5 / share)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            found, part, y = rows[i]
            now = rate * (1 - done / steps)
            done += 1
            if not len(found):
                continue
            hidden = part @ vectors[found]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            p *= weight[y]
            vectors[found] -= (now * len(found) ** 0.5) * part[:, None] * (p @ out)
            out -= now * p[:, None] * hidden
            bias -= 0.1 * now * p
    return SubwordClassifier(vectors @ (out[1] - out[0]), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 2000, text: str = "text",
          doc_id: str = "doc_id") -> SubwordClassifier:
    """A model from at most ``2 * per_class`` rows."""
    @F.pandas_udf("found binary, part binary")
    def hashed(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([[a.tobytes() for a in counted(x)] for x in texts], columns=["found", "part"])

    rows = training_rows(docs, labels, label, per_class, text, doc_id).select("id", "label", hashed("text").alias("x"))
    return fitted(rows.select("id", "label", "x.found", "x.part"), lambda r: fit(
        [(np.frombuffer(a, np.int32), np.frombuffer(b, np.float32), y) for a, b, y in zip(r["found"], r["part"], r["label"], strict=True)]))


def scored(docs: DataFrame, model: SubwordClassifier, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` between 0 and 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield texts.map(shared.value.score, na_action=None).astype(float)

    return docs.withColumn("score", score(F.col(text).cast("string")))
