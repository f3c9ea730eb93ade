"""Graph snapshots: JSON Lines folders, per-label CSV, text summary, and import."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwarden.model import EDGE_SCHEMA, PROPS, UNIQUE_KEYS, VERTEX_SCHEMA
from tierwarden.operators.catalog import grouped, union_all
from tierwarden.operators.durable import scratch_path, write_through
from tierwarden.operators.graph import (
    EDGE_KEY, as_vertices, distinct_edges, distinct_vertices, graph_summary, merge_edges, merge_vertices, property_text, split_rows, vertex_id,
)
from tierwarden.operators.identity import Keys, merged_vertices, moved_edges, survivors

NODE_FILE = T.StructType([T.StructField("id", T.StringType()),
                          T.StructField("labels", T.ArrayType(T.StringType())),
                          T.StructField("properties", PROPS)])
EDGE_FILE = T.StructType([T.StructField("id", T.StringType()), T.StructField("type", T.StringType()),
                          T.StructField("from_id", T.StringType()),
                          T.StructField("from_labels", T.ArrayType(T.StringType())),
                          T.StructField("to_id", T.StringType()),
                          T.StructField("to_labels", T.ArrayType(T.StringType())),
                          T.StructField("properties", PROPS)])

TRACKED, SLICES = 64, 64      # ids whose edges are dealt to several keys, and to how many
# Lines are compressed: they repeat every name. Compressed files are not split, so their length is bounded.
LINES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 500_000}


def edge_id() -> Column:
    return F.sha2(F.concat_ws("\u0001", "src", "type", "dst"), 256)


def _crowded(edges: DataFrame, ends: tuple[str, ...]) -> dict[str, list[str]]:
    """The ids that hold a large share of the edges, for each end: at most ``TRACKED`` of them, from one pass that keeps a few counters a task."""
    found = edges.agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"approx_top_k({end}, {TRACKED}, {TRACKED * 16})").alias(end) for end in ends]).first()
    return {end: [x["item"] for x in found[end] or [] if x["item"] is not None and x["count"] * TRACKED > found["n"]] for end in ends}


def _with_labels(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``edges`` with the labels of both ends as ``_src`` and ``_dst``.

    Edges pile up on few ids (a tier holds every record). Rows of such an id compress so well that adaptive execution does not see
    a large partition, so they are dealt to ``SLICES`` keys each, and their vertices are given once for each of these.
    """
    crowded = _crowded(edges, ("src", "dst"))
    for end, other in (("src", "dst"), ("dst", "src")):
        ids = vertices.select(F.col("id").alias(end), F.col("labels").alias(f"_{end}"))
        on = [end]
        if crowded[end]:
            hot, one = F.col(end).isin(crowded[end]), F.array(F.lit(0))
            ids = ids.withColumn("_slice", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SLICES - 1))).otherwise(one)))
            edges = edges.withColumn("_slice", F.when(hot, F.pmod(F.xxhash64(other), F.lit(SLICES)).cast("int")).otherwise(F.lit(0)))
            on.append("_slice")
        edges = edges.join(ids, on, "left").drop("_slice")
    return edges


def snapshot_nodes(vertices: DataFrame) -> DataFrame:
    return vertices.select("id", "labels", F.col("props").alias("properties"))


def snapshot_edges(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with the labels of both ends, from the vertices themselves.

    An end outside the graph has NULL labels.
    """
    return _link_rows(_with_labels(vertices, edges))


def _link_rows(labelled: DataFrame) -> DataFrame:
    return labelled.select(edge_id().alias("id"), "type", F.col("src").alias("from_id"),
                           F.col("_src").alias("from_labels"), F.col("dst").alias("to_id"),
                           F.col("_dst").alias("to_labels"), F.col("props").alias("properties"))


def _in_ranges(df: DataFrame, part: str, *key: str) -> DataFrame:
    """Rows dealt by ``part`` and a hash of their ``key``.

    A label that holds most of the graph is spread over all ranges, and no pass over the data looks for split points.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(F.col(part), F.pmod(F.xxhash64(*key), F.lit(ranges)))


def export_snapshot(vertices: DataFrame, edges: DataFrame, path: str) -> None:
    """Write nodes by label and edges by type as JSON Lines; every file is in id order."""
    nodes = snapshot_nodes(vertices).withColumn("label", F.element_at("labels", 1))
    (_in_ranges(nodes, "label", "id").sortWithinPartitions("label", "id")
     .write.mode("overwrite").partitionBy("label").options(**LINES).json(f"{path}/nodes"))
    # the digest is made after the rows are dealt: it does not compress, and would be most of what is shuffled
    links = _link_rows(_in_ranges(_with_labels(vertices, edges), "type", "src", "dst")).withColumn("edge_type", F.col("type"))
    (links.sortWithinPartitions("edge_type", "id")
     .write.mode("overwrite").partitionBy("edge_type").options(**LINES).json(f"{path}/relationships"))


def property_keys(vertices: DataFrame) -> dict[str, list[str]]:
    """label -> sorted property names.  Metadata: its size is that of the schema, not of the data."""
    pairs = (vertices.select("labels", F.explode(F.map_keys("props")).alias("key")).distinct()
             .select(F.explode("labels").alias("label"), "key").distinct())
    out: dict[str, list[str]] = {}
    for row in pairs.collect():
        out.setdefault(row["label"], []).append(row["key"])
    return {label: sorted(keys) for label, keys in out.items()}


def label_table(vertices: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """Flat table of one label: id, then every property key in name order."""
    return (vertices.where(F.array_contains("labels", label))
            .select("id", *[F.col("props")[k].alias(k) for k in keys if k != "id"]))


def export_label_csv(vertices: DataFrame, path: str) -> list[str]:
    """One CSV folder per label that has vertices; returns the labels written."""
    keys = property_keys(vertices)
    for label, names in sorted(keys.items()):
        (label_table(vertices, label, names).orderBy("id")
         .write.mode("overwrite").option("header", True).csv(f"{path}/nodes_{label}"))
    return sorted(keys)


def export_typed_csv(typed: dict[str, DataFrame], path: str) -> dict[str, list[str]]:
    """One CSV folder per label, in id order; returns the columns of each.

    Each label's frame is read once, and its columns come from its schema, so nothing is collected.
    """
    columns = {}
    for label, df in typed.items():
        keys = sorted(df.columns)
        table = label_table(as_vertices(df, label), label, keys)
        table.orderBy("id").write.mode("overwrite").option("header", True).csv(f"{path}/nodes_{label}")
        columns[label] = table.columns
    return columns


def export_graph_csv(typed: dict[str, DataFrame], path: str, ranges: int | None = None) -> dict[str, list[str]]:
    """CSV of all labels from one job: ``path/label=.../range=...``, each file with its label's header and in id order.

    Columns come from the frames' schemas. Rows are dealt by label and a hash of the id, so a label that holds most
    of the graph is written by many tasks; a label without rows has no file. Returns the columns of each label.
    """
    columns, lines = {}, []
    for label, df in typed.items():
        names = sorted(c for c in df.columns if c != "id")
        flat = df.select(vertex_id(label, UNIQUE_KEYS.get(label, "name")).alias("id"), *[property_text(df.schema[c]).alias(c) for c in names])
        columns[label] = flat.columns
        head = F.to_csv(F.struct(*[F.lit(c).alias(c) for c in flat.columns]))
        lines.append(flat.select(F.lit(label).alias("label"), "id", head.alias("head"), F.to_csv(F.struct(*flat.columns)).alias("line")))
    rows = union_all(lines)
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) if ranges is None else ranges
    rows = rows.withColumn("range", F.pmod(F.xxhash64("id"), F.lit(ranges)).cast("int"))
    first = F.row_number().over(Window.partitionBy("label", "range").orderBy("id")) == 1
    (rows.select("label", "range", F.when(first, F.concat("head", F.lit("\n"), "line")).otherwise(F.col("line")).alias("value"))
     .write.mode("overwrite").partitionBy("label", "range").text(path))
    return columns


def export_summary(vertices: DataFrame, edges: DataFrame, path: str) -> DataFrame:
    """Counts per label and type as text lines; returns the counts."""
    return write_summary(graph_summary(vertices, edges), path)


def write_summary(counts: DataFrame, path: str) -> DataFrame:
    """Counts (kind, name, n) as text lines; returns the counts."""
    line = F.concat(F.rpad(F.concat_ws(" ", "kind", "name"), 40, " "), F.col("n").cast("string"))
    (counts.orderBy("kind", F.col("n").desc(), "name").select(line.alias("value"))
     .write.mode("overwrite").text(f"{path}/summary"))
    return counts


def read_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) of a stored snapshot; FileNotFoundError when a part is missing."""
    def part(name: str, schema: T.StructType) -> DataFrame:
        try:
            return spark.read.schema(schema).json(f"{path}/{name}")
        except AnalysisException as err:
            if "PATH_NOT_FOUND" in str(err):
                raise FileNotFoundError(f"{path}/{name}") from err
            raise

    nodes, links = part("nodes", NODE_FILE), part("relationships", EDGE_FILE)
    none = F.create_map().cast(PROPS)
    return (nodes.select("id", "labels", F.coalesce("properties", none).alias("props")),
            links.select(F.col("from_id").alias("src"), F.col("to_id").alias("dst"), "type",
                         F.coalesce("properties", none).alias("props")))


def keep_connected(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges whose two ends are both known, of stored ``edges``.

    Ends pile up on few ids (a tier holds every record), so distinct ends are looked up, which are combined before the shuffle.
    Edges themselves move only if some end is not known.
    """
    whole = edges.where("src is not null and dst is not null")
    ends = whole.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    unknown = write_through(ends.join(ids.select("id"), "id", "left_anti"), scratch_path(edges.sparkSession, "unknown"))
    if unknown.isEmpty():
        return whole
    for end in ("src", "dst"):
        whole = whole.join(unknown.select(F.col("id").alias(end)), end, "left_anti")
    return whole.select(edges.columns)


def import_snapshot(spark: SparkSession, path: str,
                    existing: tuple[DataFrame, DataFrame] | None = None,
                    wipe: bool = False, keys: Keys | None = None) -> tuple[DataFrame, DataFrame]:
    """Snapshot merged into ``existing`` (vertices, edges); ``wipe`` starts from nothing.

    Repeated ids of the snapshot are folded into one vertex first.  With ``keys`` (label -> property, or a list of
    properties and tuples of them) vertices of one label that agree in a business key are one, whatever their ids and
    through however many others (``identity``): nothing of any of them is lost, and edges move to the survivor.
    Extra labels are added, and an edge with an end outside the snapshot is left out.
    """
    nodes, links = read_snapshot(spark, path)
    # Parsed once: folding, joining both ends and merging read them again.
    nodes = _once(write_through(nodes, scratch_path(spark, "nodes")), ["id"], distinct_vertices)
    links = keep_connected(write_through(links, scratch_path(spark, "links")), nodes.select("id"))
    links = _once(links, EDGE_KEY, distinct_edges)
    if existing is None or wipe:
        return nodes.select(VERTEX_SCHEMA.names), links.select(EDGE_SCHEMA.names)
    if keys:
        moved = write_through(survivors(existing[0], nodes, keys), scratch_path(spark, "moved"))
        mine, theirs = (write_through(moved_edges(e, moved), scratch_path(spark, "moved-edges")) for e in (existing[1], links))
        return merged_vertices(existing[0], nodes, moved), _merged_edges(mine, theirs)
    return merge_vertices(existing[0], nodes), merge_edges(existing[1], links)


def _once(rows: DataFrame, key: list[str], fold) -> DataFrame:
    """``rows`` with one row for each key; they are folded only if some key repeats.

    Equal keys have equal hashes, so keys are compared only if a hash repeats: a pass over numbers settles most tables.
    """
    if _hashes_differ(rows, key):
        return rows
    repeated = grouped(rows, key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows if repeated.isEmpty() else fold(rows)


def _hashes_differ(rows: DataFrame, key: list[str]) -> bool:
    return rows.groupBy(F.xxhash64(*key).alias("hash")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def _merged_edges(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """``merge_edges`` of stored edges that may repeat; where no edge comes twice there is nothing to fold."""
    both = mine.unionByName(theirs)
    if _hashes_differ(both, EDGE_KEY):
        return both.withColumn("props", F.coalesce("props", F.create_map().cast(PROPS)))
    return merge_edges(distinct_edges(mine), distinct_edges(theirs))


def replace_graph(vertices: DataFrame, edges: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Replace-all load of the generic graph, stored by label and type; returns the stored frames."""
    (vertices.withColumn("label", F.element_at("labels", 1))
     .write.mode("overwrite").partitionBy("label").parquet(f"{path}/vertices"))
    (edges.withColumn("edge_type", F.col("type"))
     .write.mode("overwrite").partitionBy("edge_type").parquet(f"{path}/edges"))
    spark = vertices.sparkSession
    return (spark.read.schema(VERTEX_SCHEMA).parquet(f"{path}/vertices").select(VERTEX_SCHEMA.names),
            spark.read.schema(EDGE_SCHEMA).parquet(f"{path}/edges").select(EDGE_SCHEMA.names))


def store_rows(rows: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """``replace_graph`` of graph rows, by one job: vertices by label and edges by type; returns the stored frames."""
    part = F.coalesce("type", F.element_at("labels", 1))
    (rows.withColumn("kind", F.when(F.col("type").isNull(), "vertex").otherwise("edge")).withColumn("part", part)
     .write.mode("overwrite").partitionBy("kind", "part").parquet(path))
    schema = T.StructType([*rows.schema.fields, T.StructField("kind", T.StringType()), T.StructField("part", T.StringType())])
    back = rows.sparkSession.read.schema(schema).parquet(path)
    return split_rows(back.where("kind = 'vertex'"))[0], split_rows(back.where("kind = 'edge'"))[1]
