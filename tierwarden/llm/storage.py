"""Intermediate tables and connected components on the shared folder of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwarden.operators.durable import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back: a lineage cut that outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of the undirected ``edges`` (a, b): the smallest node reachable.

    Alternating large-star and small-star rounds; each round is a group minimum (combined before the
    shuffle) and a join, stored under the shared folder, until a round changes nothing. The rounds grow
    with the logarithm of the graph, never with a group's size, and no neighbour list is collected.
    """
    def fingerprint(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def star(pairs: DataFrame, both: bool) -> DataFrame:
        ends = pairs.select("a", "b")
        if both:
            ends = ends.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        hung = ends.join(least, "a")
        if both:      # larger neighbours move to the minimum
            moved = hung.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:         # smaller neighbours and the node itself move to the minimum
            moved = hung.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        return moved.filter(F.col("a") != F.col("b")).distinct()

    pairs = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct(), "links")
    before = fingerprint(pairs)
    while before[0]:
        pairs = stored(star(star(pairs, True), False), "links")
        after = fingerprint(pairs)
        if after == before:
            break
        before = after
    return (pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(pairs.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
