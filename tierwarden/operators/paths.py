"""Paths over (src, dst) edges: fixed length, bounded to a root, unbounded downwards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwarden.operators.catalog import union_all
from tierwarden.operators.durable import cut_lineage


def catalog_paths(catalog: DataFrame, database: str, schema: str) -> DataFrame:
    """Database -> Schema -> Table -> Column as an array of four names.

    The catalog row already carries the whole chain, so no join is needed.
    """
    return catalog.select(F.array(F.lit(database), F.lit(schema), F.col("table_name"),
                                  F.col("column_name")).alias("path"))


def paths_to_root(nodes: DataFrame, edges: DataFrame, max_hops: int) -> DataFrame:
    """(start, path, hops): paths of 0..max_hops edges ending in a vertex without outgoing edge.

    ``nodes(id)``, ``edges(src, dst)`` without duplicates.  Such a path is a walk
    from its root against the edges, read backwards, so only vertices that do
    reach a root within the bound are ever touched.
    """
    roots = nodes.select("id").join(edges.select(F.col("src").alias("id")).distinct(), "id", "left_anti")
    against = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    alone = roots.select(F.col("id").alias("start"), F.array("id").alias("path"), F.lit(0).alias("hops"))
    longer = descend(against, roots, max_hops).select(
        F.element_at("path", -1).alias("start"), F.reverse("path").alias("path"), "hops")
    return alone.unionByName(longer)


def descend(edges: DataFrame, roots: DataFrame, max_hops: int | None = None) -> DataFrame:
    """(start, path, hops) for every path of at least one edge leading down from ``roots(id)``.

    One level per step.  Each level is written to reliable storage before the
    next is planned, so the plan stays one join deep however deep the tree is,
    and a lost executor costs one level at most.  An edge is used once per path,
    so a cyclic graph ends too.  The edges are the big side of each join and one
    parent may own a third of them: adaptive execution splits that side.
    """
    kind = edges.schema["src"].dataType.simpleString()
    links = edges.select(F.col("src").alias("at"), F.col("dst").alias("_next"))
    front = roots.select(
        F.col("id").alias("start"), F.col("id").alias("at"), F.array("id").alias("path"),
        F.array().cast(f"array<struct<s:{kind},d:{kind}>>").alias("used"))
    levels: list[DataFrame] = []
    while max_hops is None or len(levels) < max_hops:
        ahead = links.join(front, "at")
        edge = F.struct(F.col("at").alias("s"), F.col("_next").alias("d"))
        level = (ahead.where(~F.array_contains("used", edge))
                 .select("start", F.col("_next").alias("at"),
                         F.array_append("path", F.col("_next")).alias("path"),
                         F.array_append("used", edge).alias("used")))
        front = cut_lineage(level)
        levels.append(front)
        if front.isEmpty():
            break
    return union_all(levels).select("start", "path", (F.size("path") - 1).alias("hops"))
