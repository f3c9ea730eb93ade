"""Graph rows against the typed graph, identity resolution against a plain union-find, CSV of all labels from one job."""

import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierwarden.model import EDGE_SCHEMA, VERTEX_SCHEMA, local_df
from tierwarden.operators import graph as G
from tierwarden.operators import identity as I
from tierwarden.sources import snapshot as S

TS = datetime(2024, 7, 1)


def plain(df):
    return sorted(str(r) for r in df.withColumns({n: F.sort_array(F.map_entries(n)) for n, t in df.dtypes if t.startswith("map")}).collect())


def test_rows_equal_the_typed_graph(spark, fixture, tmp_path):
    args = (spark, fixture.catalog, fixture.entities, fixture.policy_refs, TS)
    typed, rows = G.build_graph(*args), G.graph_rows(*args)
    vertices, edges = G.split_rows(rows)
    assert plain(vertices) == plain(typed.vertices) and plain(edges) == plain(typed.edges)
    assert plain(G.row_summary(G.graph_rows(*args, properties=False))) == plain(G.graph_summary(typed.vertices, typed.edges))
    back = S.store_rows(rows, str(tmp_path / "g"))
    assert plain(back[0]) == plain(vertices) and plain(back[1]) == plain(edges)
    assert plain(G.row_summary(rows.limit(0))) == plain(local_df(spark, [("total", "vertices", 0), ("total", "edges", 0)], "kind string, name string, n long"))


def test_every_fact_is_scanned_once(spark, tmp_path):
    from tierwarden.plans import registry
    sf = "/root/testdata/sf0.001"
    if not Path(sf).is_dir():
        pytest.skip("given tables not present")
    plan = registry.whole_graph(spark, sf, properties=False)._jdf.queryExecution().executedPlan().toString()
    for table in ("orders", "events"):
        assert plan.count(f"/{table}.parquet") == 1, table


def test_csv_of_all_labels(spark, fixture, tmp_path):
    typed = G.build_graph(spark, fixture.catalog, fixture.entities, fixture.policy_refs, TS).typed
    typed["Nothing"] = typed["Role"].limit(0)
    columns = S.export_graph_csv(typed, str(tmp_path / "csv"), ranges=3)
    assert len(columns) == 14 and not (tmp_path / "csv" / "label=Nothing").exists()
    for label, df in typed.items():
        if label == "Nothing":
            continue
        files = list((tmp_path / "csv" / f"label={label}").rglob("part-*"))
        ids = []
        for f in files:
            lines = f.read_text().splitlines()
            assert lines[0] == ",".join(columns[label]) and len(lines) > 1
            mine = [x.split(",")[0] for x in lines[1:]]
            assert mine == sorted(mine)
            ids += mine
        assert len(ids) == df.count() and len(files) <= 3
        assert columns[label] == ["id", *sorted(df.columns)]
    schema = ", ".join(f"`{c}` string" for c in columns["Product"])
    back = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(str(tmp_path / "csv" / "label=Product"))
    want = typed["Product"]
    assert plain(back.select(sorted(want.columns))) == plain(want.select([G.property_text(want.schema[c]).alias(c) for c in sorted(want.columns)]))


def test_resolution_against_union_find(spark):
    rng = random.Random(3)
    for kind in range(3):
        claims = {  # a long chain, random sharing, one claim of nearly all
            0: [(f"n{i:04}", f"c{j}") for i in range(120) for j in (i, i + 1)],
            1: [(f"n{rng.randrange(150):04}", f"c{rng.randrange(110)}") for _ in range(190)],
            2: [(f"n{i:04}", "all") for i in range(200)] + [("m1", "x"), ("m2", "x"), ("m3", "y")]}[kind]
        rng.shuffle(claims)
        top = {}

        def find(x):
            while top.setdefault(x, x) != x:
                x = top[x]
            return x
        for node, claim in claims:
            a, b = find(node), find(f"~{claim}")
            top[max(a, b)] = min(a, b)
        want = {n: find(n) for n, _ in claims if find(n) != n}
        got = I.resolved(spark.createDataFrame(claims + claims[:5], "node string, claim string"))
        assert {r.node: r.root for r in got.collect()} == want and got.count() == len(want)
    assert I.resolved(spark.createDataFrame([], "node string, claim string")).count() == 0


def test_import_joins_stored_vertices_and_loses_nothing(spark, tmp_path):
    stored = (local_df(spark, [("P:1", ["Person"], {"email": "a", "name": "Ann", "x": "1"}), ("P:2", ["Person", "Old"], {"phone": "5", "name": "Anna", "y": "2"}),
                               ("P:3", ["Person"], {"email": "z"}), ("Q:1", ["Firm"], {"email": "a"})], VERTEX_SCHEMA),
              local_df(spark, [("P:2", "Q:1", "WORKS_AT", {"since": "1"}), ("P:1", "Q:1", "WORKS_AT", {"since": "2"}), ("P:1", "P:2", "KNOWS", {})], EDGE_SCHEMA))
    there = local_df(spark, [("7", ["Person", "New"], {"email": "a", "phone": "5", "name": "A."}), ("8", ["Person"], {"first": "B", "last": "C", "v": "8"}),
                             ("9", ["Person"], {"first": "B", "last": "C", "w": "9"}), ("10", ["Person"], {"first": "B"}), ("P:3", ["Person"], {"email": "q"})], VERTEX_SCHEMA)
    links = local_df(spark, [("7", "8", "KNOWS", {}), ("9", "10", "KNOWS", {}), ("9", "7", "KNOWS", {}), ("8", "7", "KNOWS", {})], EDGE_SCHEMA)
    S.export_snapshot(there, links, str(tmp_path))
    vertices, edges = S.import_snapshot(spark, str(tmp_path), stored, keys={"Person": ["email", "phone", ("first", "last")]})
    assert {r.id: (r.labels, r.props) for r in vertices.collect()} == {
        "P:1": (["Person", "Old", "New"], {"email": "a", "phone": "5", "name": "A.", "x": "1", "y": "2"}),
        "P:3": (["Person"], {"email": "q"}), "Q:1": (["Firm"], {"email": "a"}), "10": (["Person"], {"first": "B"}),
        "8": (["Person"], {"first": "B", "last": "C", "v": "8", "w": "9"})}
    assert {(r.src, r.dst, r.type): r.props for r in edges.collect()} == {
        ("P:1", "Q:1", "WORKS_AT"): {"since": "2"}, ("P:1", "P:1", "KNOWS"): {}, ("P:1", "8", "KNOWS"): {}, ("8", "10", "KNOWS"): {}, ("8", "P:1", "KNOWS"): {}}
    alone = S.import_snapshot(spark, str(tmp_path), stored, keys={"Person": "nothing"})
    assert alone[0].count() == 8
