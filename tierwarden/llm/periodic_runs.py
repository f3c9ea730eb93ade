"""Periodic runs of words, and texts with the repetitions taken out.

A run is a stretch of words with smallest period q, at least ``least`` and at least 2 * q words long, that no
neighbouring word extends. With l the longest common prefix (LCP) of the suffixes at a run's
start and one period later, the run has l + q words, so l >= least / 2. Suffixes are ranked by prefix doubling from that length on, only
those whose first words occur twice; LCPs of neighbours in suffix order come from the ranks of all lengths.

Suffix classes are then united by decreasing LCP (Kruskal's order, union-find). A class is its ordered positions, the
smaller one is merged into the larger. Two positions that become adjacent at level l and lie at most l apart
have the smallest period q = their distance, for l + q words: a shorter period would put a position of the class between
them. They are a run's start if the words before them differ. A run's first two periods begin at adjacent
positions, so every run is found, once.

Texts are independent rows: batches of bounded size run through numpy, words coded per text, without any shuffle.

Defined results: null and empty texts have no words and no runs; words are bytes between ASCII white space,
compared exactly; repeated rows and rows of one id each keep their row; a text costs O(n log n) time and about 150 bytes for each word.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BYTES = 1 << 21      # texts that go through numpy together

Spread = Callable[[int, list[bytes]], list[bytes]]


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of which, for every tenth id (by CRC-32 of its decimal text), the tail repeats a stretch three to ten times."""
    if doc_id is None or not words:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    start = g % len(words)
    period = 1 + (len(words) - start) // (3 + g % 8)
    tail = words[start:start + period]
    return words[:start] + (tail * (1 + (len(words) - start) // period))[:len(words) - start]


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key, kind="stable")
    placed = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(placed[1:] != placed[:-1])))
    return rank


def _with(rank: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """The rank at ``at`` together with that ``step`` words on."""
    far = np.minimum(at + step, len(rank) - 1)
    return rank[at] * (len(rank) + 1) + np.where(at + step < len(rank), rank[far] + 1, 0)


def _ranked(ids: np.ndarray, least: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Positions whose first ``least`` words occur elsewhere, in suffix order; ranks by the length they look at."""
    every = np.arange(len(ids))
    levels, size = [(1, ids.astype(np.int64))], 1
    while size * 2 <= least:
        levels.append((size * 2, _dense(_with(levels[-1][1], every, size))))
        size *= 2
    if size < least:
        levels.append((least, _dense(_with(levels[-1][1], every, least - size))))      # two overlapping prefixes
    # from now on a rank is the place of a group's first member, so that groups can be split one by one
    counts = np.bincount(levels[-1][1])
    rank = (np.cumsum(counts) - counts)[levels[-1][1]]
    levels[-1] = (least, rank)
    active = np.flatnonzero(counts[_dense(rank)] > 1) if len(rank) else every
    repeated, size = active, least
    while len(active):
        key = _with(rank, active, size)
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = rank[active]
        first = np.concatenate(([True], old[1:] != old[:-1]))
        begins = np.concatenate(([True], key[1:] != key[:-1]))
        place = np.arange(len(active))
        group = np.maximum.accumulate(np.where(first, place, 0))
        inner = np.maximum.accumulate(np.where(begins, place, 0))
        rank = rank.copy()
        rank[active] = old + inner - group
        size *= 2
        levels.append((size, rank))
        alone = begins & np.concatenate((begins[1:], [True]))
        active = active[~alone]
    return repeated[np.argsort(rank[repeated], kind="stable")], levels


def _lcp(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = len(levels[0][1])
    done = np.zeros(len(a), np.int64)
    for size, rank in reversed(levels):
        x, y = np.minimum(a + done, n - 1), np.minimum(b + done, n - 1)
        done += size * ((rank[x] == rank[y]) & (a + done < n) & (b + done < n))
    return done


def find_runs(ids: np.ndarray, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in a sequence of numbers below its length, by start and period."""
    half = (least + 1) // 2
    if len(ids) < least:
        return []
    order, levels = _ranked(ids, half)
    if not len(order):
        return []
    shared = _lcp(levels, order[:-1], order[1:])
    edges = np.flatnonzero(shared >= half)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    words, place, level = ids.tolist(), order.tolist(), shared.tolist()
    top, members, runs = list(range(len(place))), [[p] for p in place], []

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    def seed(i: int, j: int, length: int) -> None:
        if j - i <= length and j - i + length >= least and (i == 0 or words[i - 1] != words[j - 1]):
            runs.append((i, j - i + length, j - i))

    for edge in edges.tolist():
        a, b, length = find(edge), find(edge + 1), level[edge]
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large, small = members[a], members[b]
        last = len(small) - 1
        spots = [bisect_left(large, x) for x in small]
        for t, (x, k) in enumerate(zip(small, spots, strict=True)):
            if k and (not t or small[t - 1] < large[k - 1]):
                seed(large[k - 1], x, length)
            if k < len(large) and (t == last or large[k] < small[t + 1]):
                seed(x, large[k], length)
        if last < 8:
            for t, (x, k) in enumerate(zip(small, spots, strict=True)):
                large.insert(k + t, x)
        else:
            large += small
            large.sort()      # two sorted stretches, merged
        top[b], members[b] = a, []
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _coded(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words, different in every text, one text after the other; where each text begins."""
    parts, base, begins = [], 0, [0]
    for words in texts:
        if words:
            coded = pa.array(words, pa.binary()).dictionary_encode()
            parts.append(coded.indices.to_numpy() + np.int64(base))
            base += len(coded.dictionary)
        begins.append(begins[-1] + len(words))
    return np.concatenate(parts) if parts else np.empty(0, np.int64), np.array(begins)


def runs_of(df: DataFrame, least: int = 12, spread: Spread | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, runs (start, length, period, by start and period) and collapsed, the words outside of repetitions joined by spaces.

    A word is a repetition if some run contains it after the run's first period. ``spread`` may change a
    text's words beforehand, given its id.
    """
    run = "struct<start:bigint,length:bigint,period:bigint>"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                base = sizes[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(sizes, base + BYTES)))
                yield worked(batch.slice(at, stop - at))
                at = stop

    def worked(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.column("doc_id").to_pylist()
        texts = [(t or b"").split() for t in batch.column("text").cast(pa.binary()).to_pylist()]
        if spread is not None:
            texts = [spread(i, t) for i, t in zip(names, texts, strict=True)]
        ids, begins = _coded(texts)
        found = np.array(find_runs(ids, least), np.int64).reshape(-1, 3)
        of = np.searchsorted(begins, found[:, 0], side="right") - 1
        bounds = np.searchsorted(of, np.arange(len(texts) + 1))
        change = np.zeros(len(ids) + 1, np.int64)
        np.add.at(change, found[:, 0] + found[:, 2], 1)
        np.add.at(change, found[:, 0] + found[:, 1], -1)
        keep = np.cumsum(change)[:-1] == 0
        collapsed = []
        for i, words in enumerate(texts):
            if bounds[i] < bounds[i + 1]:
                words = [words[j] for j in np.flatnonzero(keep[begins[i]:begins[i + 1]])]
            collapsed.append(b" ".join(words))
        structs = pa.StructArray.from_arrays([pa.array(found[:, 0] - begins[of]), pa.array(found[:, 1]), pa.array(found[:, 2])],
                                             names=["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), structs),
             pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])

    return (df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(each, f"doc_id long, runs array<{run}>, collapsed string"))


def longest(runs: str = "runs") -> Column:
    """The run of greatest length; of equals the first, then that of the shortest period."""
    return F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"), r.alias("run"))))["run"]
