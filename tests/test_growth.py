"""What grows with the tables: lines written, rows sent to the driver, nodes in the rounds of identity resolution, copies of the statements."""

import gzip
import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from tierwarden.model import EDGE_SCHEMA, TAG_FIELDS, VERTEX_SCHEMA, local_df
from tierwarden.operators import catalog as C
from tierwarden.operators import identity as I
from tierwarden.plans import registry as R
from tierwarden.sources import snapshot as S
from tierwarden.sources.merged import MergedTable
from test_merged import ROWS


def test_export_compresses_lines_and_spreads_a_crowded_end(spark, tmp_path):
    """A hub holds all edges, one end is outside the graph and one edge has none; files are compressed and in id order."""
    vertices = [("Hub:1", ["Hub"], {})] + [(f"N:{i}", ["N"], {"v": str(i)}) for i in range(300)]
    edges = [(f"N:{i}", "Hub:1", "IN", {}) for i in range(300)] + [("N:1", "Gone:1", "IN", {}), ("N:2", None, "IN", {})]
    v, e = local_df(spark, vertices, VERTEX_SCHEMA), local_df(spark, edges, EDGE_SCHEMA)
    assert S._crowded(e, ("src", "dst")) == {"src": [], "dst": ["Hub:1"]}
    S.export_snapshot(v, e, str(tmp_path))
    files = list(tmp_path.rglob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    links = []
    for f in tmp_path.glob("relationships/*/part-*"):
        rows = [json.loads(x) for x in gzip.open(f, "rt")]
        assert [r["id"] for r in rows] == sorted(r["id"] for r in rows)
        links += rows
    labels = {i: x for i, x, _ in vertices}
    assert sorted((r["from_id"], str(r.get("to_id")), str(r.get("from_labels")), str(r.get("to_labels"))) for r in links) == sorted(
        (s, str(d), str(labels.get(s)), str(labels.get(d))) for s, d, _, _ in edges)
    back = S.import_snapshot(spark, str(tmp_path))
    assert back[0].count() == 301 and {r.src for r in back[1].collect()} == {f"N:{i}" for i in range(300)} and back[1].count() == 300


def test_large_keyed_tables_are_not_broadcast(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), ROWS)
    for n, v in ((150_000, "base"), (60_000, "new")):
        table.upsert(spark.range(n).select(F.col("id").alias("k"), F.lit("x").alias("part"), F.lit(v).alias("v")))
    assert table.store.most("rows") == 210_000
    rows = table.read()
    assert rows.groupBy("v").count().collect() and "Broadcast" not in rows._jdf.queryExecution().executedPlan().toString()
    tags = local_df(spark, [("T", "a", *[None] * 5)], "table_name string, column_name string, " + ", ".join(f"{f} string" for f in TAG_FIELDS))
    known = local_df(spark, [("S", "T", "a", 1)], "table_schema string, table_name string, column_name string, ordinal_position int")
    found = C.column_catalog(tags, known)
    assert found.count() == 1 and "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_rounds_see_only_nodes_that_connect(spark, monkeypatch):
    """Two hundred nodes with one claim hang on it without taking part; one smaller than all others becomes the root."""
    seen, real = [], I._connected

    def counted(held):
        seen.append(held.count())
        return real(held)
    monkeypatch.setattr(I, "_connected", counted)
    claims = [(f"n{i:04}", "x") for i in range(200)] + [("m", "x"), ("m", "y"), ("z", "y"), ("z", "w"), ("a", "w"), ("q1", "own"), ("q2", "own")]
    got = {r.node: r.root for r in I.resolved(spark.createDataFrame(claims, "node string, claim string")).collect()}
    assert got == {**{f"n{i:04}": "a" for i in range(200)}, "m": "a", "z": "a", "q2": "q1"}
    assert seen == [5]


def test_deliveries_are_stored_once(spark, tmp_path):
    sf, path = tmp_path / "sf", tmp_path / "out"
    rows = spark.range(40).select(
        F.when(F.col("id") > 0, F.col("id")).alias("l_orderkey"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        F.lit(1.0).alias("l_quantity"), F.lit(1.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"),
        F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz").alias("l_shipdate"))
    rows.write.parquet(f"{sf}/lineitem.parquet")
    seen = []

    class Drained:
        def awaitTermination(self):
            seen.append(spark.read.parquet(f"{path}/statements").count())
    R._arriving(spark, str(sf), str(path), 4, lambda statements: Drained())
    assert seen == [9, 19, 29, 39]      # the row without an order is in no delivery
    assert [p.name for p in Path(path).iterdir()] == ["statements"]
    assert spark.read.parquet(f"{path}/statements").columns == ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate"]
