from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierwarden.model import EDGE_SCHEMA, UNIQUE_KEYS, VERTEX_SCHEMA, local_df
from tierwarden.operators import catalog as C
from tierwarden.operators import graph as G
from tierwarden.plans import access as A
from tierwarden.sources import snapshot as S

TS = datetime(2024, 7, 1)


@pytest.fixture(scope="module")
def graph(spark, fixture):
    g = G.build_graph(spark, fixture.catalog, fixture.entities, fixture.policy_refs, TS)
    return g, g.vertices.cache(), g.edges.cache()


def comparable(df):
    """Frames with maps cannot be set-compared; maps become sorted entries."""
    return df.withColumns({n: F.sort_array(F.map_entries(n)) for n, t in df.dtypes if t.startswith("map")})


def same(a, b):
    a, b = comparable(a), comparable(b.select(a.columns))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_counts(graph):
    _, vertices, edges = graph
    found = {(r.kind, r.name): r.n for r in G.graph_summary(vertices, edges).collect()}
    labels = {"Column": 81, "Customer": 10, "Employee": 10, "Product": 10, "Transaction": 10, "AuditLog": 10,
              "Policy": 9, "Role": 7, "Table": 5, "Classification": 4, "Database": 1, "Schema": 1,
              "AccessControlConfig": 1}
    types = {"HAS_COLUMN": 81, "CLASSIFIED_AS": 81, "HAS_CLASSIFICATION": 50, "CAN_ACCESS": 19, "MASKS": 12,
             "MADE_TRANSACTION": 10, "INHERITS_FROM": 6, "REPORTS_TO": 6, "CONTAINS_TABLE": 5, "CONTAINS_SCHEMA": 1}
    assert {k[1]: n for k, n in found.items() if k[0] == "label"} == labels
    assert {k[1]: n for k, n in found.items() if k[0] == "type"} == types
    assert found[("total", "vertices")] == 159 and found[("total", "edges")] == 271


def test_reduced_data_set(spark):
    from fixture import SmallFixture
    small = SmallFixture(spark)
    g = G.build_graph(spark, small.catalog, small.entities, small.policy_refs, TS)
    assert dict(tuple(r) for r in C.tier_coverage(small.catalog).collect()) == {
        "Internal": 12, "PII": 8, "Restricted": 12, "Public": 10}
    found = {(r.kind, r.name): r.n for r in G.graph_summary(g.vertices, g.edges).collect()}
    assert found[("total", "vertices")] == 88 and found[("total", "edges")] == 150
    assert {k[1]: n for k, n in found.items() if k[0] == "type"} == {
        "HAS_COLUMN": 42, "CLASSIFIED_AS": 42, "CAN_ACCESS": 19, "HAS_CLASSIFICATION": 18, "MASKS": 11,
        "INHERITS_FROM": 6, "CONTAINS_TABLE": 5, "MADE_TRANSACTION": 3, "REPORTS_TO": 3, "CONTAINS_SCHEMA": 1}
    assert A.encryption_gaps(small.catalog).count() == 0


def test_keys_unique_and_edges_connected(graph):
    g, vertices, edges = graph
    assert vertices.select("id").distinct().count() == 159
    for label, key in UNIQUE_KEYS.items():
        assert C.check_unique(g.typed[label], key).count() == 0
    assert S.keep_connected(edges, vertices.select("id")).count() == 271


def test_record_properties(graph):
    g, _, _ = graph
    c = g.typed["Customer"].first()
    assert c.data_classification == "Restricted" and c.restricted_fields == ["ssn"] and "ssn" not in c.asDict()
    assert c.pii_fields == sorted(c.pii_fields) and len(c.pii_fields) == 7
    assert g.typed["AuditLog"].first().data_classification == "Internal"


def test_mask_edges_need_both_ends(spark, fixture):
    few = G.columns_frame(fixture.catalog.where("column_name <> 'PERSONAL_EMAIL'"), TS)
    assert G.masks(fixture.policy_refs, few, fixture.policies).count() == 11


def test_generic_form_restores_types(fixture):
    for table, label in (("CUSTOMERS", "Customer"), ("PRODUCTS", "Product"), ("EMPLOYEES", "Employee")):
        typed = G.records(fixture.entities[table], table, None, "warehouse", TS)
        assert same(typed, G.from_vertices(G.as_vertices(typed, label), label, typed.schema))


def test_snapshot_round_trip(spark, graph, tmp_path):
    _, vertices, edges = graph
    S.export_snapshot(vertices, edges, str(tmp_path))
    back_v, back_e = S.import_snapshot(spark, str(tmp_path))
    assert same(vertices, back_v) and same(edges, back_e)
    # Into itself: nothing changes.
    again_v, again_e = S.import_snapshot(spark, str(tmp_path), existing=(vertices, edges))
    assert same(vertices, again_v) and same(edges, again_e)
    # Wiping first drops what was there.
    other = local_df(spark, [("X:1", ["X"], {})], VERTEX_SCHEMA)
    assert S.import_snapshot(spark, str(tmp_path), existing=(other, edges), wipe=True)[0].count() == 159
    assert S.import_snapshot(spark, str(tmp_path), existing=(other, edges))[0].count() == 160


def test_snapshot_missing_part(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        S.import_snapshot(spark, str(tmp_path / "nowhere"))


def test_snapshot_cases(spark, tmp_path):
    vertices = local_df(spark, [
        ("Table:A", ["Table"], {"name": "A"}),
        ("Column:A.EMAIL", ["Column", "Sensitive"], {"name": "EMAIL", "owner": "x"}),
        ("Column:B.EMAIL", ["Column"], {"name": "EMAIL"}),
        ("Customer:1", ["Customer"], {"customer_id": "1"})], VERTEX_SCHEMA)
    edges = local_df(spark, [
        ("Table:A", "Column:A.EMAIL", "HAS_COLUMN", {}), ("Table:A", "Column:A.EMAIL", "HAS_COLUMN", {}),
        ("Table:A", "Column:GONE", "HAS_COLUMN", {})], EDGE_SCHEMA)
    path = str(tmp_path)
    S.export_snapshot(vertices, edges, path)
    stored = spark.read.schema(S.EDGE_FILE).json(f"{path}/relationships").where("to_id = 'Column:A.EMAIL'").first()
    assert stored.to_labels == ["Column", "Sensitive"] and stored.from_labels == ["Table"]
    gone = spark.read.schema(S.EDGE_FILE).json(f"{path}/relationships").where("to_id = 'Column:GONE'").first()
    assert gone.to_labels is None
    v, e = S.import_snapshot(spark, path)
    assert v.count() == 4 and e.count() == 1
    existing = local_df(spark, [("Column:A.EMAIL", ["Column", "Old"], {"owner": "y", "kept": "1"})], VERTEX_SCHEMA)
    merged, _ = S.import_snapshot(spark, path, existing=(existing, G.empty_edges(spark)))
    row = merged.where("id = 'Column:A.EMAIL'").first()
    assert row.labels == ["Column", "Old", "Sensitive"]
    assert row.props == {"name": "EMAIL", "owner": "x", "kept": "1"}


def test_csv_and_summary(spark, graph, tmp_path):
    _, vertices, edges = graph
    written = S.export_label_csv(vertices, str(tmp_path))
    assert len(written) == 13
    products = spark.read.option("header", True).csv(f"{tmp_path}/nodes_Product")
    assert products.columns == ["id"] + sorted(products.columns[1:]) and products.count() == 10
    assert products.where("product_name = 'Laptop 15\"'").count() == 1 or \
        "Laptop 15" in products.orderBy("id").first().product_name
    S.export_summary(vertices, edges, str(tmp_path))
    lines = [r.value for r in spark.read.text(f"{tmp_path}/summary").collect()]
    assert any(x.startswith("total vertices") and x.endswith("159") for x in lines)


def test_merge_vertices(spark):
    old = local_df(spark, [("Table:A", ["Table"], {"name": "A", "made": "1", "v": "4"}),
                           ("Table:B", ["Table"], {"name": "B"})], VERTEX_SCHEMA)
    new = local_df(spark, [("Table:A", ["Table"], {"name": "A2", "made": "2"}),
                           ("Table:C", ["Table"], {"name": "C", "made": "3"})], VERTEX_SCHEMA)
    out = {r.id: r.props for r in G.merge_vertices(old, new, create_only=("made",), counter="v").collect()}
    assert out == {"Table:A": {"name": "A2", "made": "1", "v": "5"}, "Table:B": {"name": "B"},
                   "Table:C": {"name": "C", "made": "3", "v": "1"}}


def test_merge_edges_and_rebuild(spark):
    old = local_df(spark, [("a", "b", "T", {"x": "1"}), ("a", "c", "U", {})], EDGE_SCHEMA)
    new = local_df(spark, [("a", "b", "T", {"y": "2"}), ("a", "b", "T", {"y": "2"})], EDGE_SCHEMA)
    out = {(r.src, r.dst, r.type): r.props for r in G.merge_edges(old, new).collect()}
    assert out == {("a", "b", "T"): {"x": "1", "y": "2"}, ("a", "c", "U"): {}}
    rebuilt = G.replace_edges(old, "T", local_df(spark, [("q", "r", "T", {})], EDGE_SCHEMA))
    assert {(r.src, r.type) for r in rebuilt.collect()} == {("q", "T"), ("a", "U")}


def test_chain_for_new_tables(spark, fixture, graph):
    """A newly governed table brings its own part of the chain; the rest is not doubled."""
    _, vertices, edges = graph
    extra = local_df(spark, [("NEW", "C1")], "table_name string, column_name string")
    merged = G.ensure_chain(vertices, edges, extra, "warehouse", TS)
    assert merged[0].count() == 159 + 1
    kinds = {r.type: r.n for r in G.type_counts(merged[1]).collect()}
    assert kinds["CONTAINS_TABLE"] == 6 and kinds["CONTAINS_SCHEMA"] == 1


def test_replace_all_load(spark, graph, tmp_path):
    _, vertices, edges = graph
    v, e = S.replace_graph(vertices, edges, str(tmp_path))
    assert same(vertices, v) and same(edges, e)
    v, _ = S.replace_graph(vertices.limit(3), edges, str(tmp_path / "other"))
    assert v.count() == 3


def test_import_folds_ids_and_keeps_foreign_labels(spark, tmp_path):
    vertices = local_df(spark, [
        ("17", ["Customer"], {"customer_id": "5", "name": "a"}), ("17", ["Vip"], {"name": "b"}),
        ("18", ["Transaction"], {"transaction_id": "t"}), ("19", ["Role"], {})], VERTEX_SCHEMA)
    edges = local_df(spark, [("17", "18", "MADE_TRANSACTION", {"k": "1"}), ("17", "18", "MADE_TRANSACTION", {"k": "2"})], EDGE_SCHEMA)
    path = str(tmp_path)
    S.export_snapshot(vertices, edges, path)
    row = spark.read.schema(S.EDGE_FILE).json(f"{path}/relationships").where("to_labels is not null").first()
    assert row.to_labels == ["Transaction"] and row.from_labels in (["Customer"], ["Vip"])
    v, e = S.import_snapshot(spark, path)
    folded = {r.id: (r.labels, r.props) for r in v.collect()}
    assert len(folded) == v.count() == 3 and folded["17"] == (["Customer", "Vip"], {"customer_id": "5", "name": "b"})
    assert [r.props for r in e.collect()] == [{"k": "2"}]
    existing = (local_df(spark, [("Customer:5", ["Customer"], {"customer_id": "5", "old": "1"}), ("19", ["Role"], {"x": "y"})], VERTEX_SCHEMA),
                local_df(spark, [("Customer:5", "19", "KNOWS", {})], EDGE_SCHEMA))
    v, e = S.import_snapshot(spark, path, existing=existing, keys={"Customer": "customer_id", "Transaction": "transaction_id"})
    merged = {r.id: r.props for r in v.collect()}
    assert merged == {"Customer:5": {"customer_id": "5", "old": "1", "name": "b"}, "18": {"transaction_id": "t"}, "19": {"x": "y"}}
    assert {(r.src, r.dst, r.type) for r in e.collect()} == {("Customer:5", "18", "MADE_TRANSACTION"), ("Customer:5", "19", "KNOWS")}
