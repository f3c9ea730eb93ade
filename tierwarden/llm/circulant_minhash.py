"""Near-duplicate documents by circulant MinHash.

One bijection of 32-bit values scatters the shingles, a second one ranks them; the k-th signature
coordinate is the least rank of the scattered values shifted by k around the 2**32 circle. All
coordinates come from these two permutations, without one hash function for each.

Texts of equal shingle sets form a class and only its smallest id goes on. Bands of coordinates
are bucket keys. Every bucket has a centre, its member with the most bucket mates over all bands, and members are
first compared with the centre only; verified links are closed to components. Buckets whose
members are then of one component are done.

In the others let D(x) be the symmetric difference of x and the centre c, u(x) the number of its elements that can be shared
with another component, and, for a link at p percent, w(x) = (100 + p) |D(x)| - (100 - p) |x|. Then
x and y are linked just if 2 (100 + p) |D(x) ^ D(y)| >= w(x) + w(y), counting common elements. Unless both
are linked to c, the right side is positive: a link between components shows in a common element of D. So members are joined on the
elements of D, the rarest first and no more than the threshold asks for (prefix filter), if the sums above can be reached with u(x)
by a partner that reaches x in its turn (``partnered``). In a group that shares an element, the first that a pair shares, u counts
from there on, and those without a partner go once more. A group that is then small gives its pairs that pass the filters; a larger one is treated as a bucket in its turn, with a centre of its own, until
none is left: a group never contains the centre it came from, so it gets smaller. So a group of near copies costs comparisons with a few centres instead of all pairs, and no link that joins two
components is left out. Every link is confirmed on the full sets: 100 * intersection >= percent * union.

Defined results: null and empty texts have no shingles and link with nothing; fewer words than
``width`` make one shingle; repeated rows belong to one class and each keeps its row; rows of one id with
different texts are one node; a null id names no component. Input columns are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwarden.llm.shingles import ascii_words, mix64, shingle_hashes
from tierwarden.llm.storage import components, stored

BANDS, ROWS = 32, 5
PAIRED = 128         # members of a group that are compared with each other
STEP = np.uint32(0x9E3779B1)      # distance of neighbouring shifts on the circle


def scatter(shingles: np.ndarray) -> np.ndarray:
    """First permutation: 64-bit shingle hashes to places on the 2**32 circle."""
    return (mix64(shingles) >> np.uint64(32)).astype(np.uint32)


def rank(places: np.ndarray) -> np.ndarray:
    """Second permutation, in place: a bijection of 32-bit values."""
    places ^= places >> np.uint32(16)
    places *= np.uint32(0x85EBCA6B)
    places ^= places >> np.uint32(13)
    places *= np.uint32(0xC2B2AE35)
    places ^= places >> np.uint32(16)
    return places


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates; coordinate k is the least rank after a shift by k steps."""
    shifts = (np.arange(size, dtype=np.uint64) * np.uint64(STEP)).astype(np.uint32)[:, None]
    places = scatter(shingles)
    least = np.full(size, 2**32 - 1, np.uint32)
    for at in range(0, len(places), 512):     # blocks that stay in cache
        np.minimum(least, rank(places[None, at:at + 512] + shifts).min(axis=1), out=least)
    return least


def _keys(least: np.ndarray, bands: int) -> np.ndarray:
    rows = least.reshape(bands, -1).astype(np.uint64)
    key = np.arange(bands, dtype=np.uint64)
    for column in rows.T:
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + column + np.uint64(1))
    return key.view(np.int64)


def _name(found: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    return np.array([np.bitwise_xor.reduce(mix64(found + np.uint64(i))) if len(found) else 0 for i in (1, 2)], np.uint64).tobytes()


def signed(df: DataFrame, width: int, bands: int, rows: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, a 128-bit name of the shingle set, and the band keys."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for one in batch["text"]:
                found = np.unique(shingle_hashes(ascii_words(one), width))
                keys = _keys(signature(found, bands * rows), bands) if len(found) else np.empty(0, np.int64)
                out.append((len(found), _name(found), keys))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_shingles": [x[0] for x in out],
                                "name": [x[1] for x in out], "bands": [x[2] for x in out]})

    return (df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
            .mapInPandas(each, "doc_id long, n_shingles long, name binary, bands array<long>"))


def sets_of(df: DataFrame, width: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, its shingle hashes and their name."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.unique(shingle_hashes(ascii_words(x), width)) for x in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "name": [_name(x) for x in found],
                                "shingles": [x.view(np.int64) for x in found]})

    return (df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
            .mapInPandas(each, "doc_id long, name binary, shingles array<long>"))


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) with sizes n_a, n_b and n_shared. A pair moves one set; the other side's set moves once."""
    big = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b")), "b")
    both = big.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a")), "a")
    return both.select("a", "b", F.size("of_a").alias("n_a"), F.size("of_b").alias("n_b"),
                       F.size(F.array_intersect("of_a", "of_b")).alias("n_shared"))


def linked(measured: DataFrame, percent: int) -> DataFrame:
    return measured.filter(F.col("n_shared") * 100 >= percent * (F.col("n_a") + F.col("n_b") - F.col("n_shared"))).select("a", "b")


def with_centres(groups: DataFrame) -> DataFrame:
    """(grp, doc_id) with the centre of each group: its member with the most mates in all groups, of equals the smallest id."""
    sized = groups.join(groups.groupBy("grp").agg(F.count("*").alias("mates")).filter("mates > 1"), "grp")
    weight = sized.groupBy("doc_id").agg(F.sum("mates").alias("weight"))
    centres = (sized.join(weight, "doc_id").groupBy("grp").agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("id"))).alias("top"))
               .select("grp", (-F.col("top.id")).alias("centre")))
    return sized.select("grp", "doc_id").join(centres, "grp")


def united(of: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) with what the new ``links`` connect made one; only components they join are worked on."""
    if of is None:
        return stored(components(links), "grouped")
    named = [of.select(F.col("node").alias(end), F.col("component").alias(f"c_{end}")) for end in ("a", "b")]
    between = stored(links.join(named[0], "a", "left").join(named[1], "b", "left")
                     .select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b")).filter("a <> b").distinct(), "between")
    if between.isEmpty():
        return of
    more = stored(components(between), "united")
    moved = of.join(more.select(F.col("node").alias("component"), F.col("component").alias("now")), "component", "left")
    return stored(moved.select("node", F.coalesce("now", "component").alias("component"))
                  .union(more.join(of.select("node"), "node", "left_anti").select("node", "component")), "grouped")


def partnered(members: DataFrame, by: str, both: int) -> DataFrame:
    """``members`` (u, w, outside) of the groups ``by`` that can have a partner there, with the least w of those, and of unlinked ones.

    With at most u(x) common elements the reach of x is 2 ``both`` u(x) - w(x). A partner's w is within x's reach, and x's w within
    the partner's, so the least w among the members that reach x decides. They are compared in steps of 2 ``both``, which lets in some more.
    """
    step = 2 * both
    members = members.withColumn("reach", step * F.col("u") - F.col("w")).withColumn("at", F.floor(F.col("w") / step))
    reached = (members.groupBy(by, F.floor(F.col("reach") / step).alias("at"))
               .agg(F.min("w").alias("least_w"), F.min(F.when(F.col("outside"), F.col("w"))).alias("least_out")))
    asked = members.select(by, "at", F.lit(None).cast("long").alias("least_w"), F.lit(None).cast("long").alias("least_out")).distinct()
    up = Window.partitionBy(by).orderBy(F.desc("at"))      # a row for each step, whatever the number of members
    least = (reached.union(asked).groupBy(by, "at").agg(F.min("least_w").alias("least_w"), F.min("least_out").alias("least_out"))
             .select(by, "at", F.min("least_w").over(up).alias("least_w"), F.min("least_out").over(up).alias("least_out")))
    return members.join(least, [by, "at"]).filter(F.when(F.col("outside"), F.col("least_w")).otherwise(F.col("least_out")) <= F.col("reach"))


def across(star: DataFrame, measured: DataFrame, sets: DataFrame, grouped: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """What may still link two components: pairs (a, b), and groups (grp, doc_id) too large for pairs."""
    both, room, no = 100 + percent, 100 - percent, F.lit(False)
    of = grouped.select(F.col("node").alias("doc_id"), "component")
    placed = star.join(of, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    mixed = placed.groupBy("grp").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    members = (placed.join(mixed.select("grp"), "grp", "left_semi").filter("doc_id <> centre")
               .select("centre", "doc_id", "component").distinct())
    differs = F.col("n_a") + F.col("n_b") - 2 * F.col("n_shared")
    rest = (members.join(measured, (F.col("a") == F.col("centre")) & (F.col("b") == F.col("doc_id")))
            .select("centre", "doc_id", "component", (both * differs - room * F.col("n_b")).cast("long").alias("w"),
                    (room * F.col("n_a")).cast("long").alias("z")).withColumn("outside", F.col("w") > F.col("z")))
    own = sets.select("doc_id", "shingles")
    apart = F.concat(F.array_except("shingles", "of_centre"), F.array_except("of_centre", "shingles"))
    # a centre without unlinked members needs no second look
    open_ = rest.groupBy("centre").agg(F.max("outside").alias("some")).filter("some").select("centre")
    elements = stored(rest.join(open_, "centre", "left_semi").join(own, "doc_id")
                      .join(own.select(F.col("doc_id").alias("centre"), F.col("shingles").alias("of_centre")), "centre")
                      .select(*rest.columns, F.explode(apart).alias("element")), "elements")
    # elements that two components share, an unlinked member among them
    held = (elements.groupBy("centre", "element").agg(F.count("*").alias("holders"), F.min("component").alias("lo"), F.max("component").alias("hi"),
                                                      F.max("outside").alias("some")).filter("lo < hi and some").select("centre", "element", "holders"))
    useful = elements.join(held, ["centre", "element"])
    own_row = ["centre", "doc_id"]
    u = useful.groupBy(*own_row).agg(F.count("*").alias("u"), F.min("w").alias("w"), F.max("outside").alias("outside"))
    able = stored(partnered(u, "centre", both).select(*own_row, "u", "least_w", "least_out"), "able")
    nth = F.row_number().over(Window.partitionBy(*own_row).orderBy("holders", "element"))      # at most the elements of two texts
    ranked = useful.withColumn("nth", nth).join(able, own_row)
    # least overlaps with an unlinked partner, and of an unlinked one with a linked partner
    near = F.greatest(F.lit(1), F.ceil((F.col("w") + F.greatest(F.col("z") + 1, F.col("least_out"))) / (2 * both)))
    far = F.greatest(F.lit(1), F.ceil((F.col("w") - F.col("z")) / 200), F.ceil((F.col("w") + F.col("least_w")) / (2 * both)))
    ranked = (ranked.withColumn("near", F.col("least_out").isNotNull() & (F.col("nth") <= F.col("u") - near + 1))
              .withColumn("far", F.when(F.col("outside"), F.col("nth") <= F.col("u") - far + 1).otherwise(no)).filter("near or far"))
    # where an element is the first that two share, the elements after it are all that they can share besides
    ranked = stored(ranked.select(F.xxhash64("centre", "element").alias("grp"), "doc_id", "component", "w", (F.col("u") - F.col("nth") + 1).alias("u"),
                                  "outside", "near", "far"), "ranked")
    groups = (ranked.groupBy("grp").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("outside").alias("some"))
              .filter("lo < hi and some").select("grp"))
    left = stored(partnered(ranked.join(groups, "grp", "left_semi"), "grp", both).drop("reach", "at", "least_w", "least_out"), "partners")
    sizes = left.groupBy("grp").agg(F.count("*").alias("size"), F.min("component").alias("lo"), F.max("component").alias("hi"),
                                    F.max("outside").alias("some")).filter("lo < hi and some").select("grp", "size")
    left = stored(left.join(sizes, "grp"), "left")
    x, y = left.filter(f"size <= {PAIRED} and outside").alias("x"), left.filter(f"size <= {PAIRED}").alias("y")
    fits = 2 * both * F.least("x.u", "y.u") >= F.col("x.w") + F.col("y.w")
    role = F.when(F.col("y.outside"), F.col("x.near") & F.col("y.near") & (F.col("x.doc_id") < F.col("y.doc_id"))).otherwise(F.col("x.far") & F.col("y.near"))
    pairs = (x.join(y, (F.col("x.grp") == F.col("y.grp")) & (F.col("x.component") != F.col("y.component")) & fits & role)
             .select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct())
    return pairs, left.filter(f"size > {PAIRED}").select("grp", "doc_id").distinct()


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id linked to, itself included), kept; one row for each row of ``df``."""
    docs = stored(signed(df, width, bands, rows, text, doc_id), "signed")
    # one representative for each shingle set; the minimum is combined before the shuffle
    classes = stored(docs.filter("n_shingles > 0").groupBy("name").agg(F.min("doc_id").alias("rep")), "classes")
    reps = (docs.select("doc_id", "name", "bands")
            .join(classes.select(F.col("rep").alias("doc_id"), "name"), ["doc_id", "name"])
            .select("doc_id", "name", "bands").dropDuplicates(["doc_id", "name"]))
    buckets = stored(reps.select(F.explode("bands").alias("grp"), "doc_id").distinct(), "buckets")
    star = stored(with_centres(buckets), "star")
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    candidates = source.join(star.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = stored(sets_of(candidates, width).dropDuplicates(["doc_id", "name"]), "sets")

    of = None
    while True:
        first = star.filter("doc_id <> centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct()
        measured = stored(overlaps(first, sets), "measured")
        of = united(of, linked(measured, percent))
        pairs, groups = across(star, measured, sets, of, percent)
        of = united(of, linked(overlaps(pairs, sets), percent))
        star = stored(with_centres(groups), "star")
        if star.isEmpty():
            break
    named = (classes.join(of, classes.rep == of.node, "left")
             .select(F.col("name"), F.coalesce("component", "rep").alias("component")))
    return (docs.select("doc_id", "n_shingles", "name").join(named, "name", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
