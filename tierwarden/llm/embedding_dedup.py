"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine >= c lie within squared distance 2 - 2c. After a fixed random rotation they
are split into blocks of few dimensions; if two vectors are that close, then in at least one block
their squared distance is at most the block's share of the budget, in proportion to its dimensions.
So each block is a range join with a small radius r: grid cells in the block's first ``grid``
dimensions, every vector placed in all cells within r / 2 of it, since a pair within r shares the cell of its
midpoint. A pair belongs to its first block that fits and to its midpoint's cell there, so each is
confirmed (cosine of the full vectors in double precision) and counted exactly once, without a shuffle of pairs.

Equal vectors of a label form a class with a count and go through the join once. A cell of many
classes is cut into tiles, and pairs of tiles are separate tasks of bounded size. Tasks return link
counts and a spanning forest of the links found, never all pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows
without a label, link with nothing; vectors of different lengths never link; each row counts as one
vector, also when ids repeat; a null id names no component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwarden.llm.storage import components, stored

BLOCK, GRID, TILE = 8, 3, 1000
SLACK = 1e-7          # rounding of rotated coordinates


def rotation(n: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(n).normal(size=(n, n)))
    return q * np.sign(np.diag(r))


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


class Space:
    """Blocks, budgets and cells for vectors of ``n`` components."""

    def __init__(self, n: int, least: float):
        self.turn = rotation(n)
        self.blocks = [slice(a, min(n, a + BLOCK)) for a in range(0, n, BLOCK)]
        self.budgets = np.array([(2 - 2 * least) * (b.stop - b.start) / n for b in self.blocks]) + SLACK
        self.sides = 3 * np.sqrt(self.budgets) + SLACK

    def cells(self, block: int, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell coordinates) of every cell within half the radius of each row."""
        side, reach = self.sides[block], 0.5 * np.sqrt(self.budgets[block]) + SLACK
        x = turned[:, self.blocks[block]][:, :GRID] / side
        row, cell = np.arange(len(x)), np.empty((len(x), 0), np.int64)
        gap = np.zeros(len(x))
        for d in range(x.shape[1]):
            at = np.floor(x[row, d]).astype(np.int64)
            parts = []
            for step in (-1, 0, 1):
                there = at + step
                off = np.maximum(0, np.maximum(there - x[row, d], x[row, d] - there - 1)) * side
                near = gap + off * off <= reach * reach
                parts.append((row[near], np.column_stack((cell[near], there[near])), (gap + off * off)[near]))
            row, cell, gap = (np.concatenate([p[i] for p in parts]) for i in range(3))
        return row, cell

    def home(self, block: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Cell of the midpoints."""
        return np.floor((a + b)[:, self.blocks[block]][:, :GRID] * 0.5 / self.sides[block]).astype(np.int64)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of (a, b) that join two parts not joined before."""
    top = list(range(n))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    out = []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(i), find(j)
        if x != y:
            top[x] = y
            out.append((i, j))
    return out


def _linked(left: pd.DataFrame, right: pd.DataFrame | None, space: Space, block: int, cell: np.ndarray, least: float):
    """Links between two tiles (or inside one) that belong to this block and cell: positions in both."""
    u = _units(np.vstack([np.frombuffer(x, np.float64) for x in left["vector"]]))
    v = u if right is None else _units(np.vstack([np.frombuffer(x, np.float64) for x in right["vector"]]))
    tu, tv = u @ space.turn, v @ space.turn
    part = space.blocks[block]
    found_a, found_b = [], []
    for at in range(0, len(u), 256):
        p, q = tu[at:at + 256, part], tv[:, part]
        near = (p * p).sum(1)[:, None] + (q * q).sum(1)[None, :] - 2 * (p @ q.T) <= space.budgets[block]
        i, j = np.nonzero(near)
        i += at
        if right is None:
            i, j = i[i < j], j[i < j]
        for c in range(0, len(i), 65536):
            a, b = i[c:c + 65536], j[c:c + 65536]
            keep = (u[a] * v[b]).sum(1) >= least
            a, b = a[keep], b[keep]
            keep = (space.home(block, tu[a], tv[b]) == cell).all(axis=1)
            a, b = a[keep], b[keep]
            gap = (tu[a] - tv[b]) ** 2
            for earlier in range(block):
                keep = gap[:, space.blocks[earlier]].sum(1) > space.budgets[earlier]
                a, b, gap = a[keep], b[keep], gap[keep]
            found_a.append(a)
            found_b.append(b)
    return (np.concatenate(found_a) if found_a else np.empty(0, np.int64),
            np.concatenate(found_b) if found_b else np.empty(0, np.int64))


def near_vectors(df: DataFrame, least: float = 0.93, vector: str = "embedding", label: str = "label",
                 vec_id: str = "vec_id") -> DataFrame:
    """vec_id, n_links, component_id, kept; one row for each row of ``df``."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                     F.col(vector).cast("array<double>").alias("v"))
    sound = (F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
             & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("v", lambda x: x != 0))
    # 0.0 and -0.0 are one value
    rows = stored(rows.withColumn("v", F.when(F.coalesce(sound, F.lit(False)), F.transform("v", lambda x: x + F.lit(0.0))))
                  .withColumn("name", F.when(F.col("v").isNotNull(), F.sha2(F.concat_ws("|", "label", F.array_join(
                      F.transform("v", lambda x: x.cast("string")), ",")), 256))), "vectors")
    classes = stored(rows.filter("name is not null").groupBy("name")
                     .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.min("label").alias("label"),
                          F.min("v").alias("v")), "classes")

    def placed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spaces: dict[int, Space] = {}
        for part in parts:
            for n, some in part.groupby(part["v"].map(len)):
                space = spaces.setdefault(n, Space(n, least))
                vectors = np.vstack(some["v"].to_list()).astype(np.float64)
                largest = np.abs(vectors).max(axis=1, keepdims=True)
                vectors = vectors / largest          # keeps squares finite
                turned = _units(vectors) @ space.turn
                for block in range(len(space.blocks)):
                    row, cell = space.cells(block, turned)
                    yield pd.DataFrame({
                        "label": some["label"].to_numpy()[row], "n": n, "block": block, "cell": list(cell),
                        "name": some["name"].to_numpy()[row], "copies": some["copies"].to_numpy()[row],
                        "vector": [vectors[r].tobytes() for r in row]})

    cells = stored(classes.select("name", "label", "copies", "v").mapInPandas(
        placed, "label string, n int, block int, cell array<long>, name string, copies long, vector binary"), "cells")
    key = ["label", "n", "block", "cell"]
    sizes = cells.groupBy(*key).agg(F.count("*").alias("size")).filter("size > 1")
    tiled = (cells.join(sizes, key).withColumn("tiles", F.ceil(F.col("size") / TILE).cast("int"))
             .withColumn("tile", F.pmod(F.xxhash64("name"), F.col("tiles")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .withColumn("lo", F.least("tile", "other")).withColumn("hi", F.greatest("tile", "other")))

    def link(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[0]
        space, lo, hi = Space(int(first["n"]), least), first["lo"], first["hi"]
        left = group if lo == hi else group[group["tile"] == lo]
        right = None if lo == hi else group[group["tile"] == hi]
        none = pd.DataFrame(columns=["name", "other", "n_links"]).astype({"n_links": "int64"})
        if not len(left) or right is not None and not len(right):
            return none
        a, b = _linked(left, right, space, int(first["block"]), np.asarray(first["cell"]), least)
        other = left if right is None else right
        names = left["name"].to_list() + ([] if right is None else right["name"].to_list())
        shift = 0 if right is None else len(left)
        counts = np.zeros(len(names), np.int64)
        np.add.at(counts, a, other["copies"].to_numpy()[b])
        np.add.at(counts, b + shift, left["copies"].to_numpy()[a])
        edges = _forest(len(names), a, b + shift)
        some = np.flatnonzero(counts)
        return pd.concat([none, pd.DataFrame({"name": [names[i] for i in some], "other": None, "n_links": counts[some]}),
                          pd.DataFrame({"name": [names[i] for i, _ in edges], "other": [names[j] for _, j in edges],
                                        "n_links": 0})], ignore_index=True)

    found = stored(tiled.select(*key, "lo", "hi", "tile", "name", "copies", "vector").groupBy(*key, "lo", "hi")
                   .applyInPandas(link, "name string, other string, n_links long"), "linked")
    counts = found.filter("other is null").groupBy("name").agg(F.sum("n_links").alias("n_links"))
    ids = classes.select("name", "rep")
    graph = components(found.filter("other is not null").select(F.col("name").alias("a"), F.col("other").alias("b")))
    members = ids.join(graph, ids["name"] == graph["node"]).select("name", "component", "rep")
    smallest = members.groupBy("component").agg(F.min("rep").alias("least"))
    named = members.join(smallest, "component").select("name", "least")
    whole = (classes.select("name", "rep", "copies").join(counts, "name", "left").join(named, "name", "left")
             .select("name", F.coalesce("least", "rep").alias("component"),
                     (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    return (rows.select("vec_id", "name").join(whole, "name", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
