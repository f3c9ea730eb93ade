"""The two classifiers against plain versions: features, scores and training, one number at a time."""

import math
import random

import numpy as np
import pytest

from tierwarden.llm import quality, toxicity

M32 = (1 << 32) - 1
TEXTS = [None, "", "  ", "a", "bad bad BAD word", "Das ist ein  Satz, mit é und 日本!\nzweite Zeile", "x y x y " * 30, "hello-world 123 foo_bar"]


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


# ---- quality: words and n-grams, mean of vectors, softmax

def plain_features(text):
    """Hashes in no particular order."""
    words = (text or "").split()
    if not words:
        return []
    odd, out, last = 0x9E3779B1, [], None

    def mixed(c):
        x = (ord(c) + 1) * odd & M32
        return x ^ x >> 15
    for word in words:
        # the blank after the word is part of its hash
        h = sum(mixed(c) * (2 * j + 1) for j, c in enumerate(word + " ", 1)) & M32
        h = (h * odd + len(word) + 1) * 0x85EBCA6B & M32
        out.append(M32 >> 16 if h == last else h >> 16)
        last = h
    for n in (3, 4):
        for word in words:
            whole = f" {word} "
            for i in range(len(whole) - n + 1):
                h = mixed(whole[i])
                for c in whole[i + 1:i + n]:
                    h = (h * 0x01000193 + mixed(c)) & M32
                out.append((h * odd ^ n * 0x9E3779B1 & M32) >> 16 & 0xFFFF)
    return out


@pytest.mark.parametrize("text", TEXTS)
def test_quality_features(text):
    parts = list(quality.features(text))
    assert (sorted(np.concatenate(parts).tolist()) if parts else []) == sorted(plain_features(text))


def test_quality_scores_are_a_softmax_of_mean_vectors():
    rng = np.random.default_rng(1)
    vectors, out, bias = rng.normal(size=(1 << quality.HASH_BITS, 5)), rng.normal(size=(2, 5)), rng.normal(size=2)
    model = quality.SubwordClassifier((vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))
    for text in TEXTS:
        hashes = [int(h) for part in quality.features(text) for h in part]
        mean = [sum(vectors[h][k] for h in hashes) / len(hashes) if hashes else 0.0 for k in range(5)]
        z = [sum(out[y][k] * mean[k] for k in range(5)) + bias[y] for y in (0, 1)]
        assert abs(model.score(text) - math.exp(z[1]) / (math.exp(z[0]) + math.exp(z[1]))) < 1e-4


def test_quality_training_step_by_step():
    """The same gradient descent in plain loops."""
    rng = random.Random(2)
    texts = [(" ".join(rng.choice(["good", "fine", "text", "junk", "spam"][:3] if y else ["junk", "spam", "text"]) for _ in range(6)), y)
             for y in (0, 1, 1, 0, 1, 1, 0, 1)]
    rows = [(*quality.counted(t), y) for t, y in texts]
    model = quality.fit(rows, epochs=3)
    order = np.random.default_rng(5)
    first = order.uniform(-1 / quality.SIZE, 1 / quality.SIZE, (1 << quality.HASH_BITS, quality.SIZE)).astype(np.float32)
    vectors = {}
    out, bias, share, done = [[0.0] * quality.SIZE for _ in (0, 1)], [0.0, 0.0], sum(y for _, y in texts) / len(texts), 0
    for _ in range(3):
        for i in order.permutation(len(rows)):
            found, part, y = rows[i]
            rate = 0.5 * (1 - done / (3 * len(rows)))
            done += 1
            mine = [vectors.setdefault(int(f), [float(v) for v in first[f]]) for f in found]
            hidden = [sum(p * v[k] for p, v in zip(part.tolist(), mine)) for k in range(quality.SIZE)]
            z = [sum(o * h for o, h in zip(out[c], hidden)) + bias[c] for c in (0, 1)]
            e = [math.exp(x - max(z)) for x in z]
            slope = [(x / sum(e) - (c == y)) * (0.5 / share if y else 0.5 / (1 - share)) for c, x in enumerate(e)]
            back = [sum(slope[c] * out[c][k] for c in (0, 1)) for k in range(quality.SIZE)]
            for p, v in zip(part.tolist(), mine):
                for k in range(quality.SIZE):
                    v[k] -= rate * len(found) ** 0.5 * p * back[k]
            for c in (0, 1):
                bias[c] -= 0.1 * rate * slope[c]
                out[c] = [o - rate * slope[c] * h for o, h in zip(out[c], hidden)]
    for t, _ in [*texts, ("unseen words", 0)]:
        found, part = quality.counted(t)
        z = bias[1] - bias[0] + sum(p * sum((b - a) * v for a, b, v in zip(*out, vectors.get(int(f), first[f].tolist()))) for f, p in zip(found, part.tolist()))
        assert abs(model.score(t) - sigmoid(z)) < 1e-3


# ---- toxicity: factorization machine

def test_machine_scores_all_pairs():
    rng = np.random.default_rng(3)
    slots = np.zeros(1 << toxicity.HASH_BITS, np.int32)
    found = sorted({int(h) for t in TEXTS for h in toxicity.terms(t)})
    slots[found[::2]] = np.arange(1, len(found[::2]) + 1)      # every second term is a feature
    w, v = rng.normal(size=len(found) + 1).astype(np.float32) * 0.2, rng.normal(size=(len(found) + 1, 4)).astype(np.float32) * 0.2
    w[0], v[0] = 0, 0
    model = toxicity.FactorizationMachine(slots, -0.3, w, v)
    for text in TEXTS:
        x = [int(slots[h]) for h in toxicity.terms(text)]
        z = -0.3 + sum(float(w[i]) for i in x)
        z += sum(sum(float(v[i][k] * v[j][k]) for k in range(4)) for a, i in enumerate(x) for j in x[a + 1:])
        assert abs(model.score(text) - sigmoid(z)) < 1e-5


def test_machine_training_step_by_step():
    """Adagrad in batches of 64 rows, in plain loops over rows and terms."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(12)]
    texts = []
    for _ in range(150):
        words = rng.sample(vocabulary, 5)
        texts.append((" ".join(words), int("w0" in words and "w1" in words or rng.random() < 0.1)))
    rows = [(toxicity.terms(t), y) for t, y in texts]
    epochs, rate, sparse, decay, start = 2, 0.4, 0.5, 1.0, 30.0
    model = toxicity.fit(rows, epochs=epochs)
    used = sorted({int(h) for x, _ in rows for h in x if sum(int(h) in set(r.tolist()) for r, _ in rows) >= 5})
    slot = {h: i + 1 for i, h in enumerate(used)}
    order, share = np.random.default_rng(3), float(np.float32(np.mean([np.float32(y) for _, y in rows])))
    v = order.normal(0, 0.05, (len(used) + 1, toxicity.FACTORS)).astype(np.float32).astype(float)
    v[0] = 0
    w, gw, gv, bias, gb = [0.0] * (len(used) + 1), [start] * (len(used) + 1), np.full(v.shape, start), 0.0, start
    for _ in range(epochs):
        turn = order.permutation(len(rows))
        for at in range(0, len(turn), 64):
            dw, dv, errors = {}, {}, 0.0
            for i in turn[at:at + 64]:
                x, y = [slot[int(h)] for h in rows[i][0] if int(h) in slot], rows[i][1]
                if not x:
                    continue
                z = bias + sum(w[j] for j in x) + sum(float(v[a] @ v[b]) for n, a in enumerate(x) for b in x[n + 1:])
                err = (sigmoid(z) - y) * (0.5 / share if y else 0.5 / (1 - share))
                errors += err
                for j in x:
                    dw[j] = dw.get(j, 0.0) + err
                    dv[j] = dv.get(j, 0.0) + err * sum(v[b] for b in x if b != j) / len(x) ** 0.5
            for j in dw:
                gw[j] += dw[j] ** 2
                gv[j] += dv[j] ** 2
                pace = rate / gw[j] ** 0.5
                moved = w[j] - pace * dw[j]
                w[j] = math.copysign(max(0.0, abs(moved) - pace * sparse), moved)
                v[j] = v[j] - rate * (dv[j] + decay * v[j]) / gv[j] ** 0.5
            gb += errors ** 2
            bias -= rate * errors / gb ** 0.5
    assert np.allclose(model.weights, w, atol=2e-3) and np.allclose(model.factors, v, atol=2e-3) and abs(model.bias - bias) < 2e-3
