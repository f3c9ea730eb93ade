"""Hard negatives for anchors: rows of another label whose score lies in a window below a positive's.

A score is the inner product of integer vectors. The angles of every row to a few reference directions
are stored with its norm. By the triangle inequality on the sphere, the angle of rows x and y is at least
max |angle(x, d) - angle(y, d)| and at most min (angle(x, d) + angle(y, d)) over the directions d; cosines of both,
times the norms and widened by more than their rounding, bound the score. A row whose
bounds miss what an anchor still looks for gets no integer scoring.

Rows are packed into blocks of one label and nearest direction, about ``BLOCK`` rows each, and anchors likewise. Blocks know the
range of their angles and norms, so pairs of blocks are judged by the same bounds before any vector moves. What is left is
anchors against all rows, in blocks: positives first within the anchor's own cell, whose worst score is the floor for
the other cells; then negatives inside the windows of all positives. A task keeps the best few rows for each anchor over up to
``TOGETHER`` blocks, so neither all pairs nor a group of equal rows is ever sent.

Defined results: rows without an id, label or vector, or with a component that is null or not finite (also after scaling) take
no part; rows of one id are one row, that of the smallest label and vector; shorter vectors end in zeros;
zero vectors score 0; sums beyond 53 bits are worked out exactly; a reported score that does not fit a long is an error.
Extra columns are not returned. Directions come from a sample of at most ``SAMPLE`` rows, by a hash of the id; they change the cost, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwarden.llm.storage import stored

BLOCK, TOGETHER, DIRECTIONS, SAMPLE = 4096, 64, 8, 2048
WIDER = 1e-5      # radians; angles are stored with 24 bits


def directions(sample: list[list[float]], most: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors of the sample far from each other, each the farthest from those before."""
    width = max((len(v) for v in sample), default=0)
    found = np.zeros((len(sample), width))
    for i, v in enumerate(sample):
        found[i, :len(v)] = v
    norms = np.sqrt((found ** 2).sum(axis=1))
    found = found[(norms > 0) & np.isfinite(norms)] / norms[(norms > 0) & np.isfinite(norms)][:, None]
    if not len(found):
        return np.eye(1, max(1, width))
    chosen, nearest = [0], found @ found[0]
    while len(chosen) < most and nearest.min() < 1 - 1e-9:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, found @ found[chosen[-1]])
    return found[chosen]


def _matrix(vectors: list[np.ndarray], width: int = 0) -> np.ndarray:
    """Rows of one length, the shorter ones ending in zeros."""
    out = np.zeros((len(vectors), max([width, *map(len, vectors)])))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _measured(vectors: np.ndarray, towards: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the directions; zero vectors have angles 0 (their bounds are 0 anyway)."""
    most = np.maximum(np.abs(vectors).max(axis=1, initial=0), 1.0)[:, None]
    norms = np.sqrt(((vectors / most) ** 2).sum(axis=1)) * most[:, 0]
    width = max(vectors.shape[1], towards.shape[1])
    units = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1]))) / np.where(norms > 0, norms, 1)[:, None]
    cosines = units @ np.pad(towards, ((0, 0), (0, width - towards.shape[1]))).T
    return norms, np.where(norms[:, None] > 0, np.arccos(np.clip(cosines, -1, 1)), 0)


def _bounds(gap: Any, reach: Any, least: Any, most: Any, lib: Any, choose: Any) -> tuple[Any, Any]:
    """Lower and upper score for angles in [gap, reach] and products of norms in [least, most]."""
    high, low = lib.cos(gap), lib.cos(reach)
    slack = most * 1e-9 + 1e-6
    return (choose(low >= 0, low * least, low * most) - slack, choose(high >= 0, high * most, high * least) + slack)


def bounds_of(a_angles: np.ndarray, a_norms: np.ndarray, angles: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper score of every anchor with every row."""
    gap = np.zeros((len(a_angles), len(angles)), np.float32)
    reach = np.full(gap.shape, np.pi, np.float32)
    for x, y in zip(a_angles.T, angles.T, strict=True):
        np.maximum(gap, np.abs(x[:, None] - y[None, :]), out=gap)
        np.minimum(reach, x[:, None] + y[None, :], out=reach)
    size = a_norms[:, None] * norms[None, :]
    return _bounds(np.maximum(gap - WIDER, 0).astype(np.float64), np.minimum(reach + WIDER, np.pi).astype(np.float64), size, size, np, np.where)


def scores_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of integers held as doubles."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * width
    if largest < 2**53:
        return (a @ b.T).astype(np.int64)
    if largest < 2**63 and np.abs(a).max() < 2**53 and np.abs(b).max() < 2**53:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = [np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b)]
    return whole[0] @ whole[1].T


# ---- packed blocks

_PACK = ("ids binary, vectors binary, kind string, width int, norms binary, angles binary, n int, "
         "angle_lo array<double>, angle_hi array<double>, norm_lo double, norm_hi double")


def _packed(rows: pd.DataFrame) -> dict[str, Any]:
    rows = rows.sort_values("vec_id")
    vectors = _matrix([np.frombuffer(v, k) for v, k in zip(rows["vector"], rows["kind"], strict=True)])
    largest = np.abs(vectors).max(initial=0)
    kind = "<i2" if largest < 2**15 else "<i4" if largest < 2**31 else "<f8"
    norms, angles = rows["norm"].to_numpy(np.float64), np.vstack([np.frombuffer(x, "<f4") for x in rows["angles"]])
    return {"ids": rows["vec_id"].to_numpy(np.int64).tobytes(), "vectors": vectors.astype(kind).tobytes(), "kind": kind, "width": vectors.shape[1],
            "norms": norms.tobytes(), "angles": angles.tobytes(), "n": len(rows), "angle_lo": angles.min(axis=0).astype(float).tolist(),
            "angle_hi": angles.max(axis=0).astype(float).tolist(), "norm_lo": norms.min(), "norm_hi": norms.max()}


class _Unpacked:
    def __init__(self, row: dict[str, Any], prefix: str = ""):
        get = lambda name: row[prefix + name]
        self.ids = np.frombuffer(get("ids"), np.int64)
        self.vectors = np.frombuffer(get("vectors"), get("kind")).reshape(-1, get("width")).astype(np.float64)
        self.norms = np.frombuffer(get("norms"), np.float64)
        self.angles = np.frombuffer(get("angles"), "<f4").reshape(len(self.ids), -1)


def packed(rows: DataFrame, keys: list[str], size: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """A row for each block of about ``size`` rows that agree in ``keys``; columns named in ``extra`` become lists."""
    parts = rows.groupBy(*keys).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / size)).alias("parts"))
    dealt = rows.join(parts, keys).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    more = [f"{name} array<{rows.schema[name].dataType.simpleString()}>" for name in extra]
    key_types = [f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys]

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id")
        one = {k: group[k].iloc[0] for k in keys} | {"part": group["part"].iloc[0]} | _packed(group) | {k: group[k].tolist() for k in extra}
        return pd.DataFrame([one])

    kept = ["vec_id", "vector", "kind", "norm", "angles", *extra]
    out = dealt.select(*keys, "part", *kept).groupBy(*keys, "part").applyInPandas(pack, ", ".join([*key_types, "part long", _PACK, *more]))
    return out.withColumn("block", F.xxhash64(*keys, "part"))


def block_bounds() -> tuple[Column, Column]:
    """Lower and upper score of any anchor of block ``a_...`` with any row of a block."""
    apart = F.zip_with(F.zip_with("angle_lo", "a_angle_hi", lambda x, y: x - y), F.zip_with("a_angle_lo", "angle_hi", lambda x, y: x - y), lambda x, y: F.greatest(x, y))
    gap = F.greatest(F.lit(0.0), F.array_max(apart) - WIDER)
    reach = F.least(F.lit(np.pi), F.array_min(F.zip_with("angle_hi", "a_angle_hi", lambda x, y: x + y)) + WIDER)
    return _bounds(gap, reach, F.col("norm_lo") * F.col("a_norm_lo"), F.col("norm_hi") * F.col("a_norm_hi"), F,
                   lambda test, a, b: F.when(test, a).otherwise(b))


# ---- scans

class _Best:
    """The best rows of every anchor (of every list of an anchor) so far: (-score, id), at most ``size``."""

    def __init__(self, size: int):
        self.size, self.lists = size, {}

    def worst(self, key: Any) -> float:
        found = self.lists.get(key, ())
        return -found[-1][0] if len(found) == self.size else -np.inf

    def add(self, key: Any, scores: np.ndarray, ids: np.ndarray) -> None:
        new = list(zip((-scores).tolist(), ids.tolist(), strict=True))
        self.lists[key] = sorted([*self.lists.get(key, ()), *new])[:self.size]


def _top(scores: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``size`` best of rows that are in the order of ids."""
    order = np.argsort(-scores, kind="stable")[:size]
    return scores[order], ids[order]


def _positives(row: dict[str, Any], best: _Best) -> None:
    block, anchors = _Unpacked(row), _Unpacked(row, "a_")
    for at in range(0, len(anchors.ids), 64):
        part = slice(at, at + 64)
        floors = np.array([max(f, best.worst(i)) for f, i in zip(row["a_floor"][part], anchors.ids[part].tolist(), strict=True)], float)
        _, upper = bounds_of(anchors.angles[part], anchors.norms[part], block.angles, block.norms)
        wanted = (upper >= floors[:, None]) & (anchors.ids[part, None] != block.ids[None, :])
        some = np.flatnonzero(wanted.any(axis=0))
        scores = scores_of(anchors.vectors[part], block.vectors[some])
        for i, (own, anchor) in enumerate(zip(wanted[:, some], anchors.ids[part].tolist(), strict=True)):
            if own.any():
                best.add(anchor, *_top(scores[i][own], block.ids[some][own], best.size))


def _negatives(row: dict[str, Any], best: _Best) -> None:
    low, high = row["low"], row["high"]
    block, anchors = _Unpacked(row), _Unpacked(row, "a_")
    others = np.flatnonzero(np.array([x != row["label"] for x in row["a_label"]], bool))
    for at in range(0, len(others), 64):
        part = others[at:at + 64]
        windows = [[(p["id"], p["score"], -(-low * p["score"] // 100), high * p["score"] // 100) for p in row["a_positives"][i]] for i in part.tolist()]
        # what lies in no window, or below the worst of enough rows in each, is not scored
        least = np.array([min((max(w[2], best.worst((i, w[0]))) for w in ws if w[2] <= w[3]), default=np.inf)
                          for i, ws in zip(anchors.ids[part].tolist(), windows, strict=True)], float)
        most = np.array([max((w[3] for w in ws), default=-np.inf) for ws in windows], float)
        lower, upper = bounds_of(anchors.angles[part], anchors.norms[part], block.angles, block.norms)
        wanted = (upper >= least[:, None]) & (lower <= most[:, None]) & (anchors.ids[part, None] != block.ids[None, :])
        some = np.flatnonzero(wanted.any(axis=0))
        if not len(some):
            continue
        scores = scores_of(anchors.vectors[part], block.vectors[some])
        for i, ws in enumerate(windows):
            near = np.flatnonzero(wanted[i, some] & (scores[i] >= least[i]) & (scores[i] <= most[i]))
            if not len(near):
                continue
            near = near[np.argsort(-scores[i][near], kind="stable")]
            found, ids = scores[i][near], block.ids[some][near]
            for positive, score, least_score, most_score in ws:
                first = int(np.searchsorted(-found, -most_score))
                stop = min(first + best.size, int(np.searchsorted(-found, -least_score, side="right")))
                if first < stop:
                    best.add((int(anchors.ids[part[i]]), (positive, score)), found[first:stop], ids[first:stop])


def _scanned(pairs: DataFrame, size: int, work: Any, schema: str, flat: Any) -> DataFrame:
    """``work`` on all pairs of blocks, an anchor block with up to ``TOGETHER`` row blocks in one task, the most promising first."""
    names = [f.name for f in pairs.schema.fields]
    columns = [x.split()[0] for x in schema.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best = None, _Best(size)

        def done() -> pa.RecordBatch:
            rows = [(*flat(key), -s, i) for key, found in best.lists.items() for s, i in found]
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(len(columns))], names=columns)

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if (row["a_block"], row["chunk"]) != now:
                    if now is not None:
                        yield done()
                    now, best = (row["a_block"], row["chunk"]), _Best(size)
                work(row, best)
        if now is not None:
            yield done()

    return (pairs.repartition("a_block", "chunk").sortWithinPartitions("a_block", "chunk", F.desc("upper"), "block")
            .select(*names).mapInArrow(each, schema))


def mined(df: DataFrame, anchors: Column, scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
          vector: str = "embedding", label: str = "label", vec_id: str = "vec_id") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are the first ``positives`` other rows of its label; for each, the first ``negatives`` rows of another
    label with low * positive_score <= 100 * negative_score <= high * positive_score are returned. First means by score, then the smaller id.
    """
    x = F.transform(F.col(vector).cast("array<double>"), lambda v: F.when(F.abs(v) < float("inf"), v * scale))
    rows = (df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                      F.coalesce(anchors, F.lit(False)).alias("anchor"), x.alias("v"))
            .filter("vec_id is not null and label is not null and v is not null")
            .filter(F.forall("v", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False))))
            .groupBy("vec_id").agg(F.min(F.struct("label", "v", "anchor")).alias("r")).select("vec_id", "r.*"))
    rows = stored(rows, "vectors")
    sample = [r["v"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toLocalIterator()]
    towards = directions(sample)
    cells = max(1, min(len(towards), rows.count() // (4 * BLOCK)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.floor(x.values.to_numpy()) for x in batch.column("v")]
            kinds = ["<i4" if np.abs(v).max(initial=0) < 2**31 else "<f8" for v in lists]
            norms, angles = _measured(_matrix(lists, 1), towards) if lists else (np.empty(0), np.empty((0, 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("anchor"),
                 pa.array([v.astype(k).tobytes() for v, k in zip(lists, kinds, strict=True)], pa.binary()), pa.array(kinds, pa.string()),
                 pa.array(norms, pa.float64()), pa.array([a.astype("<f4").tobytes() for a in angles], pa.binary()),
                 pa.array(angles[:, :cells].argmin(axis=1) if len(angles) else [], pa.int32())],
                names=["vec_id", "label", "anchor", "vector", "kind", "norm", "angles", "near"])

    rows = stored(rows.mapInArrow(measure, "vec_id long, label string, anchor boolean, vector binary, kind string, norm double, angles binary, near int"), "measured")
    blocks = stored(packed(rows.drop("anchor"), ["label", "near"], BLOCK), "blocks")
    chunks = max(1, blocks.count() // TOGETHER)
    asking = rows.filter("anchor").drop("anchor")
    facts = ["block", "label", "near", "angle_lo", "angle_hi", "norm_lo", "norm_hi"]

    def pairs_of(who: DataFrame, met: DataFrame, keep: list[str]) -> DataFrame:
        """Pairs of blocks with the vectors of both; ``met`` has their ids and upper bound."""
        payload = blocks.select("block", "label", "ids", "vectors", "kind", "width", "norms", "angles")
        ask = who.select(*[F.col(c).alias(f"a_{c}") for c in ("block", "ids", "vectors", "kind", "width", "norms", "angles", *keep)])
        return (met.select("a_block", "block", "upper", F.pmod(F.xxhash64("block"), F.lit(chunks)).alias("chunk"))
                .join(payload, "block").join(ask, "a_block"))

    def judged(who: DataFrame, on: Column, keep: list[str]) -> DataFrame:
        ask = who.select(*[F.col(c).alias(f"a_{c}") for c in ("block", "near", "angle_lo", "angle_hi", "norm_lo", "norm_hi", *keep)])
        lower, upper = block_bounds()
        # every block meets the anchors of every cell: an equi-join on the cell
        return (blocks.select(*facts).withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
                .join(ask, (F.col("cell") == F.col("a_near")) & on).withColumn("lower", lower).withColumn("upper", upper))

    def best_of(found: DataFrame) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id"))      # at most ``positives`` rows from each task
        return found.withColumn("nth", nth).filter(F.col("nth") <= positives).drop("nth")

    def search(who: DataFrame, met: DataFrame) -> DataFrame:
        return _scanned(pairs_of(who, met, ["floor"]), positives, _positives, "anchor_id long, score long, id long", lambda key: (key,))

    # positives: in the anchor's own cell first
    ask = stored(packed(asking.withColumn("floor", F.lit(float("-inf"))), ["label", "near"], BLOCK, ("floor",)), "anchors")
    same = F.col("label") == F.col("a_label")
    first = stored(best_of(search(ask, judged(ask, same & (F.col("near") == F.col("a_near")), ["label"]))), "nearby")
    floors = first.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.count("*").alias("n"), F.min("score").cast("double").alias("floor"))
    ask = stored(packed(asking.join(floors, "vec_id", "left").withColumn("floor", F.when(F.col("n") == positives, F.col("floor")).otherwise(float("-inf"))),
                        ["label", "near"], BLOCK, ("floor",)), "anchors")
    met = judged(ask, same & (F.col("near") != F.col("a_near")), ["label", "floor"]).filter(F.col("upper") >= F.array_min("a_floor"))
    chosen = stored(best_of(first.union(search(ask, met))).withColumnRenamed("id", "positive_id"), "positives")

    # negatives: anchors of all labels together, by what their windows span
    lists = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), "score")).alias("positives"))
    asking = (asking.join(lists, "vec_id").withColumn("positives", F.filter("positives", lambda p: p["score"] >= 0))
              .filter(F.size("positives") > 0)
              .withColumn("least", F.array_min(F.transform("positives", lambda p: p["score"] * (low / 100))))
              .withColumn("most", F.array_max(F.transform("positives", lambda p: p["score"] * (high / 100)))))
    ask = stored(packed(asking, ["near"], BLOCK, ("label", "positives", "least", "most")), "anchors")
    met = (judged(ask, F.lit(True), ["label", "least", "most"])
           .filter(F.exists("a_label", lambda x: x != F.col("label")) & (F.col("upper") >= F.array_min("a_least") - 1) & (F.col("lower") <= F.array_max("a_most") + 1)))
    pairs = pairs_of(ask, met, ["label", "positives"]).withColumns({"low": F.lit(low), "high": F.lit(high)})
    found = _scanned(pairs, negatives, _negatives, "anchor_id long, positive_id long, positive_score long, negative_score long, negative_id long",
                     lambda key: (key[0], *key[1]))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
