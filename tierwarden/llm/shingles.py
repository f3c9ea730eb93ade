"""Hashed words and shingles of UTF-8 texts, worked out on whole arrays with numpy.

A shingle's hash is chained from its words' 64-bit SipHash values, with a bijective finalizer after every
word, so no arithmetic of the words carries over to the shingle. ``run_hashes`` is cheaper and only for
feature hashing: prefix sums of random values of the bytes times powers of an odd base (modulo 2**64), which
some long texts made for it can defeat.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pandas.util import hash_array

BASE = 0x9E3779B97F4A7C15 | 1
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))   # A-Z to a-z, all else as it is
_RANDOM = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def _powers(n: int, inverse: bool) -> np.ndarray:
    base = pow(BASE, -1, 1 << 64) if inverse else BASE
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``data[s:e]`` for each pair of bounds."""
    if not len(starts):
        return np.empty(0, np.uint64)
    n = len(data)
    size = 1 << max(10, n.bit_length())
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_RANDOM[np.frombuffer(data, np.uint8)] * _powers(size, False)[:n], out=sums[1:])
    value = (sums[ends] - sums[starts]) * _powers(size, True)[starts]
    return mix64(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def bounds(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in the words joined by one byte."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    return np.concatenate(([0], ends[:-1] + 1)) if len(words) else ends, ends


def ascii_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def shingle_hashes(words: list[bytes], width: int, short: bool = True) -> np.ndarray:
    """Hash of every run of ``width`` words; of the whole sequence when there are fewer and ``short``."""
    n = len(words)
    if not n or (n < width and not short):
        return np.empty(0, np.uint64)
    width = min(width, n)
    own = np.empty(n, object)
    own[:] = words
    hashes = hash_array(own, categorize=False)
    out = mix64(hashes[:n - width + 1] + np.uint64(width))
    for i in range(1, width):
        out = mix64(out * np.uint64(BASE) + hashes[i:n - width + 1 + i])
    return out
