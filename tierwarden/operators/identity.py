"""Who is who: vertices of two graphs that agree in one of their business keys.

A label has one or several business keys, each of one or several properties. Vertices of a label with equal, non-null
values of a key are one vertex, and so are those that are connected through others: two stored vertices may be
joined by an incoming one that holds a key of either. The survivor is the smallest stored id, without a stored
vertex the smallest incoming one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwarden.model import PROPS
from tierwarden.operators.catalog import grouped
from tierwarden.operators.durable import scratch_path, write_through

Keys = dict[str, str | list[str | tuple[str, ...]]]


def business_keys(keys: Keys) -> list[tuple[str, tuple[str, ...]]]:
    """(label, properties) of every key; a key of one property may be given by its name."""
    out = []
    for label, given in keys.items():
        for key in [given] if isinstance(given, str) else given:
            out.append((label, (key,) if isinstance(key, str) else tuple(key)))
    return out


def claims(vertices: DataFrame, keys: Keys) -> DataFrame:
    """(id, claim): what a vertex says it is, one row for each business key it holds a value of."""
    def claim(label: str, names: tuple[str, ...]) -> Column:
        values = [F.col("props")[n] for n in names]
        held = F.array_contains("labels", label)
        for v in values:
            held = held & v.isNotNull()
        return F.when(held, F.to_json(F.array(F.lit(label), F.lit(",".join(names)), *values)))

    every = F.array_compact(F.array(*[claim(label, names) for label, names in business_keys(keys)]))
    return vertices.select("id", F.explode(every).alias("claim"))


def _roots(parents: DataFrame) -> DataFrame:
    """(node, root) of a forest (node, parent) whose parents are smaller: each round doubles the steps made."""
    def stored(df: DataFrame) -> DataFrame:
        return write_through(df, scratch_path(parents.sparkSession, "roots"))

    found = stored(parents.select("node", F.col("parent").alias("root")))
    while True:
        up = found.select(F.col("node").alias("root"), F.col("root").alias("above"))
        nearer = found.join(up.hint("merge"), "root", "left")
        if nearer.where("above is not null").isEmpty():
            return found
        found = stored(nearer.select("node", F.coalesce("above", "root").alias("root")))


def _connected(held: DataFrame) -> DataFrame:
    """(node, root) of the nodes that are not their own root, from (node, claim): the smallest node connected by claims.

    Every round hangs each node below the smallest node of its claims, follows the chains to their ends and moves the
    claims there, so the nodes left at least halve. A claim that very many nodes share is one minimum, combined before the shuffle.
    """
    spark = held.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        return write_through(df, scratch_path(spark, name))

    pairs, of = stored(held.select("node", "claim").distinct(), "claims"), None
    while True:
        least = (pairs.groupBy("claim").agg(F.min("node").alias("least"), F.max("node").alias("most"))
                 .where("least < most").select("claim", "least"))
        shared = pairs.join(least.hint("merge"), "claim")
        parents = stored(shared.groupBy("node").agg(F.min("least").alias("parent")).where("parent < node"), "parents")
        if parents.isEmpty():
            break
        roots = _roots(parents)
        # claims of nodes without a mate are settled and need not move on
        pairs = stored(shared.select("node", "claim").join(roots.hint("merge"), "node", "left")
                       .select(F.coalesce("root", "node").alias("node"), "claim").distinct(), "claims")
        if of is None:
            of = roots
            continue
        moved = of.join(roots.select(F.col("node").alias("root"), F.col("root").alias("now")).hint("merge"), "root", "left")
        of = stored(moved.select("node", F.coalesce("now", "root").alias("root"))
                    .unionByName(roots.join(of.select("node").hint("merge"), "node", "left_anti")), "resolved")
    return held.select("node", F.col("node").alias("root")).limit(0) if of is None else of


def resolved(held: DataFrame) -> DataFrame:
    """``_connected`` of all nodes, whose rounds see only the nodes that can connect claims: those with several.

    A node with one claim belongs where its claim does. It takes part in the rounds only where it is the smallest of its claim,
    and so may be a root; a claim that only such nodes hold is settled at once.
    """
    spark = held.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        return write_through(df, scratch_path(spark, name))

    pairs = stored(held.select("node", "claim"), "held")
    several = stored(pairs.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("node"), "several").hint("merge")
    linked = stored(pairs.join(several, "node", "left_semi").distinct(), "linked")
    lone = stored(pairs.join(several, "node", "left_anti"), "lone")
    first = lone.groupBy("claim").agg(F.min("node").alias("first"))
    holder = linked.groupBy("claim").agg(F.min("node").alias("holder"))
    claims = stored(first.join(holder.hint("merge"), "claim", "left"), "firsts")
    rooted = claims.where("first < holder").select(F.col("first").alias("node"), "claim")
    of = _connected(linked.unionByName(rooted))
    least = claims.select("claim", F.least("first", "holder").alias("least"))
    settled = (least.join(of.select(F.col("node").alias("least"), "root").hint("merge"), "least", "left")
               .select("claim", F.coalesce("root", "least").alias("root")))
    return (of.join(rooted.select("node").hint("merge"), "node", "left_anti").select("node", "root")
            .unionByName(lone.join(settled.hint("merge"), "claim").where("node <> root").select("node", "root")))


def survivors(stored: DataFrame, incoming: DataFrame, keys: Keys) -> DataFrame:
    """(id, survivor) of the vertices, stored or incoming, that another one stands for."""
    known = stored.select("id", F.lit("0").alias("_age"))
    mine = claims(stored, keys).withColumn("_age", F.lit("0"))
    theirs = claims(incoming, keys).join(known.hint("merge"), "id", "left").withColumn("_age", F.coalesce("_age", F.lit("1")))
    # stored ids sort before incoming ones
    held = mine.unionByName(theirs).select(F.concat("_age", "id").alias("node"), "claim")
    return resolved(held).select(F.expr("substring(node, 2)").alias("id"), F.expr("substring(root, 2)").alias("survivor"))


def folded(rows: DataFrame) -> DataFrame:
    """One vertex for each id of (id, labels, props, age): labels united, a property from the row of greatest ``age``, of equals the greatest value.

    Labels come in the order of ``first`` (least first), then of their place. Only ids with several rows are worked on.
    """
    spark = rows.sparkSession
    # stored once: they are joined, and read for the count, the labels, the values and the rest
    rows = write_through(rows, scratch_path(spark, "placed"))
    repeated = write_through(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"),
                             scratch_path(spark, "repeated")).hint("merge")
    many = rows.join(repeated, "id", "left_semi")
    named = (grouped(many.select("id", "first", F.posexplode("labels").alias("place", "label")), ["id", "label"]).agg(F.min(F.struct("first", "place")).alias("at"))
             .groupBy("id").agg(F.sort_array(F.collect_list(F.struct("at", "label"))).alias("found"))      # as many as there are labels
             .select("id", F.transform("found", lambda x: x["label"]).alias("labels")))
    values = (grouped(many.select("id", "age", F.explode("props").alias("key", "value")), ["id", "key"]).agg(F.max(F.struct("age", "value")).alias("last"))
              .groupBy("id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "last.value")))).alias("props")))
    none = F.create_map().cast(PROPS)
    ids = repeated.join(named.hint("merge"), "id", "left").join(values.hint("merge"), "id", "left")
    return (rows.join(repeated, "id", "left_anti").select("id", "labels", "props")
            .unionByName(ids.select("id", F.coalesce("labels", F.array().cast("array<string>")).alias("labels"),
                                    F.coalesce("props", none).alias("props"))))


def merged_vertices(stored: DataFrame, incoming: DataFrame, moved: DataFrame) -> DataFrame:
    """Both graphs' vertices under their survivors. An incoming value wins over a stored one, the survivor's own over another stored one's."""
    def placed(df: DataFrame, own: int, other: int, first: Column) -> DataFrame:
        there = df.join(moved.hint("merge"), "id", "left").withColumn("moved", F.col("survivor").isNotNull())
        return there.select(F.coalesce("survivor", "id").alias("id"), "labels", "props",
                            F.when(F.col("moved"), F.lit(other)).otherwise(F.lit(own)).alias("age"), first.alias("first"))

    mine = placed(stored, 1, 0, F.when(F.col("moved"), F.lit(1)).otherwise(F.lit(0)))
    return folded(mine.unionByName(placed(incoming, 2, 2, F.lit(2))))


def moved_edges(edges: DataFrame, moved: DataFrame) -> DataFrame:
    """Edges with both ends at their survivors; a hot end's partition is split adaptively, the edges being the left side."""
    for end in ("src", "dst"):
        there = moved.select(F.col("id").alias(end), "survivor").hint("merge")
        edges = edges.join(there, end, "left").withColumn(end, F.coalesce("survivor", end)).drop("survivor")
    return edges.select("src", "dst", "type", "props")
