"""The governance graph as vertex and edge DataFrames.

Typed frames (one per label) are the working form.  The generic form used for
snapshots is ``vertices(id, labels, props)`` and ``edges(src, dst, type, props)``
with ids ``Label:key``, so an id never depends on the run that produced it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwarden.functions.text import column_fqn, table_fqn
from tierwarden.model import (
    DATABASE, EDGE_SCHEMA, KEY_OF, LABEL_OF, PROPS, RANKS, SCHEMA, TIER_OVERRIDES, TIER_SHEET,
    UNCLASSIFIED, UNIQUE_KEYS, can_access_df, inherits_df, local_df, policies_df, roles_df, tiers_df,
)
from tierwarden.operators.catalog import grouped, union_all
from tierwarden.sources.entities import minimise, with_provenance

EDGE_KEY = ["src", "dst", "type"]


def _no_props() -> Column:
    return F.create_map().cast(PROPS)


def vertex_id(label: str, key: Column | str) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(f"{label}:"), key.cast("string"))


def edges_of(df: DataFrame, src: Column, dst: Column, kind: str) -> DataFrame:
    return df.select(src.alias("src"), dst.alias("dst"), F.lit(kind).alias("type"), _no_props().alias("props"))


@dataclass
class Graph:
    typed: dict[str, DataFrame]
    edges: DataFrame

    @property
    def vertices(self) -> DataFrame:
        return union_all([as_vertices(df, label) for label, df in self.typed.items()])


# -- catalog part ------------------------------------------------------------

def columns_frame(catalog: DataFrame, run_ts, database: str = DATABASE, schema: str = SCHEMA) -> DataFrame:
    """Column vertices: the filled catalog plus keys and provenance."""
    return catalog.select(
        column_fqn("table_name", "column_name", database, schema).alias("fqn"),
        F.col("column_name").alias("name"), "table_name",
        *[c for c in catalog.columns if c not in ("table_name", "column_name")],
        F.lit(True).alias("tagged"), F.lit(run_ts).alias("ingested_at"))


def tables_frame(catalog: DataFrame, run_ts, platform: str,
                 database: str = DATABASE, schema: str = SCHEMA) -> DataFrame:
    return catalog.select("table_name").distinct().select(
        table_fqn("table_name", database, schema).alias("fqn"), F.col("table_name").alias("name"),
        F.lit(schema).alias("schema_name"), F.lit(database).alias("database_name"),
        F.lit(platform).alias("source_platform"), F.lit(run_ts).alias("ingested_at"))


def schemas_frame(spark: SparkSession, database: str = DATABASE, schema: str = SCHEMA) -> DataFrame:
    return local_df(spark, [(f"{database}.{schema}", schema, database)],
                    "fqn string, name string, database_name string")


def databases_frame(spark: SparkSession, platform: str, run_ts, database: str = DATABASE) -> DataFrame:
    return (local_df(spark, [(database, database, platform, "Production")],
                     "fqn string, name string, platform string, environment string")
            .withColumn("created_at", F.lit(run_ts)))


def catalog_edges(spark: SparkSession, catalog: DataFrame,
                  database: str = DATABASE, schema: str = SCHEMA) -> DataFrame:
    """Database -> Schema -> Table -> Column."""
    top = local_df(spark, [(database, f"{database}.{schema}")], "db string, sch string")
    tables = catalog.select("table_name").distinct()
    table_id = vertex_id("Table", table_fqn("table_name", database, schema))
    return union_all([
        edges_of(top, vertex_id("Database", "db"), vertex_id("Schema", "sch"), "CONTAINS_SCHEMA"),
        edges_of(tables, F.lit(f"Schema:{database}.{schema}"), table_id, "CONTAINS_TABLE"),
        edges_of(catalog, table_id,
                 vertex_id("Column", column_fqn("table_name", "column_name", database, schema)), "HAS_COLUMN"),
    ])


def build_catalog_graph(spark: SparkSession, catalog: DataFrame, run_ts, platform: str = "warehouse",
                        database: str = DATABASE, schema: str = SCHEMA) -> Graph:
    """Database, Schema, Table and Column vertices with the edges between them."""
    typed = {"Database": databases_frame(spark, platform, run_ts, database),
             "Schema": schemas_frame(spark, database, schema),
             "Table": tables_frame(catalog, run_ts, platform, database, schema),
             "Column": columns_frame(catalog, run_ts, database, schema)}
    return Graph(typed, catalog_edges(spark, catalog, database, schema))


def classified_as(columns: DataFrame, tiers: DataFrame) -> DataFrame:
    """Column -> Classification, re-derived from the column's tag."""
    known = columns.where(F.col("data_classification").isNotNull()
                          & (F.col("data_classification") != UNCLASSIFIED))
    tier = tiers.select(F.col("name").alias("data_classification"))
    return edges_of(known.join(tier, "data_classification", "left_semi"),
                    vertex_id("Column", "fqn"), vertex_id("Classification", "data_classification"),
                    "CLASSIFIED_AS")


def role_edges(can_access: DataFrame, inherits: DataFrame) -> DataFrame:
    return edges_of(can_access, vertex_id("Role", "role"), vertex_id("Classification", "classification"),
                    "CAN_ACCESS").unionByName(
        edges_of(inherits, vertex_id("Role", "parent"), vertex_id("Role", "child"), "INHERITS_FROM"))


def masks(policy_refs: DataFrame, columns: DataFrame, policies: DataFrame) -> DataFrame:
    """Policy -> Column for masking policies; pairs with an unknown end drop out."""
    bound = (policy_refs.where(F.col("policy_kind") == "MASKING_POLICY")
             .select("table_name", F.col("column_name").alias("name"), "policy_name"))
    known = policies.select(F.col("name").alias("policy_name"))
    both = columns.select("table_name", "name", "fqn").join(bound, ["table_name", "name"]) \
                  .join(known, "policy_name", "left_semi")
    return edges_of(both, vertex_id("Policy", "policy_name"), vertex_id("Column", "fqn"), "MASKS")


# -- record part -------------------------------------------------------------

def sheet_tiers(table: str) -> dict[str, str]:
    """column (lower case) -> tier for one of the five governed tables."""
    return {c.lower(): tier for tier, names in TIER_SHEET[table.upper()].items() for c in names}


def table_tier(table: str, tiers: dict[str, str], overrides: dict[str, str] | None = None) -> str:
    """Record tier of a table: its most sensitive column, unless overridden."""
    overrides = TIER_OVERRIDES if overrides is None else overrides
    return overrides.get(table.upper()) or min(tiers.values(), key=RANKS.__getitem__)


def records(df: DataFrame, table: str, tiers: dict[str, str] | None = None,
            platform: str | None = None, run_ts=None, field_lists: bool = True, extra: tuple[str, ...] = ()) -> DataFrame:
    """Record vertices of one entity: safe columns, tier, field lists, provenance; ``extra`` columns of the entity beside them."""
    tiers = sheet_tiers(table) if tiers is None else tiers
    out = minimise(df, table, extra).withColumn("data_classification", F.lit(table_tier(table, tiers)))
    if field_lists:
        wanted = {"CUSTOMERS": ("PII", "Restricted"), "EMPLOYEES": ("PII", "Restricted"),
                  "PRODUCTS": ("Public", "Restricted"), "FINANCIAL_TRANSACTIONS": ("Restricted",),
                  "AUDIT_LOGS": ()}[table.upper()]
        for tier in wanted:
            names = sorted(c for c, t in tiers.items() if t == tier)
            out = out.withColumn(f"{tier.lower()}_fields", F.array(*map(F.lit, names)))
    return out if platform is None else with_provenance(out, table, platform, run_ts)


def has_classification(recs: DataFrame, label: str, key: str, tiers: DataFrame) -> DataFrame:
    tier = tiers.select(F.col("name").alias("data_classification"))
    return edges_of(recs.join(tier, "data_classification", "left_semi"), vertex_id(label, key),
                    vertex_id("Classification", "data_classification"), "HAS_CLASSIFICATION")


def reports_to_pairs(employees: DataFrame) -> DataFrame:
    """(employee_id, manager_id) where the manager exists.

    One manager may have a third of all employees: adaptive execution splits that key.
    """
    reports = employees.select("employee_id", "manager_id").where(F.col("manager_id").isNotNull())
    managers = employees.select(F.col("employee_id").alias("manager_id"))
    return reports.join(managers, "manager_id", "left_semi").select("employee_id", "manager_id")


def reports_to(employees: DataFrame) -> DataFrame:
    return edges_of(reports_to_pairs(employees), vertex_id("Employee", "employee_id"),
                    vertex_id("Employee", "manager_id"), "REPORTS_TO")


def made_transaction(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer -> Transaction for known customers; a dominant customer's partition is split adaptively."""
    pairs = (transactions.select("customer_id", "transaction_id")
             .join(customers.select("customer_id"), "customer_id", "left_semi"))
    return edges_of(pairs, vertex_id("Customer", "customer_id"), vertex_id("Transaction", "transaction_id"),
                    "MADE_TRANSACTION")


# -- generic form ------------------------------------------------------------

def property_text(field: T.StructField) -> Column:
    """A property as text; nested values as JSON."""
    nested = isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
    return F.to_json(field.name) if nested else F.col(field.name).cast("string")


def _props(schema: T.StructType) -> Column:
    pairs = [c for f in schema.fields for c in (F.lit(f.name), property_text(f))]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def as_vertices(df: DataFrame, label: str, key: str | None = None) -> DataFrame:
    """Typed frame -> (id, labels, props); NULL properties are left out."""
    key = UNIQUE_KEYS.get(label, "name") if key is None else key
    return df.select(vertex_id(label, key).alias("id"), F.array(F.lit(label)).alias("labels"), _props(df.schema).alias("props"))


def from_vertices(vertices: DataFrame, label: str, schema: T.StructType) -> DataFrame:
    """Inverse of ``as_vertices`` for one label."""
    def value(field: T.StructField) -> Column:
        raw = F.col("props")[field.name]
        nested = isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
        return (F.from_json(raw, field.dataType) if nested else raw.cast(field.dataType)).alias(field.name)

    return vertices.where(F.array_contains("labels", label)).select([value(f) for f in schema.fields])


def build_graph(spark: SparkSession, catalog: DataFrame, entities: dict[str, DataFrame],
                policy_refs: DataFrame, run_ts, platform: str = "warehouse",
                database: str = DATABASE, schema: str = SCHEMA,
                can_access: DataFrame | None = None, inherits: DataFrame | None = None,
                tiers: dict[str, dict[str, str]] | None = None) -> Graph:
    """Whole governance graph as one lazy plan; write it partitioned by label / type.

    The catalog feeds two vertex labels and four edge types, so hand in a stored
    one rather than one still to be pivoted.
    """
    tier_rows = tiers_df(spark)
    base = build_catalog_graph(spark, catalog, run_ts, platform, database, schema)
    columns = base.typed["Column"]
    policies = policies_df(spark)
    can_access = can_access_df(spark) if can_access is None else can_access
    inherits = inherits_df(spark) if inherits is None else inherits
    typed = {
        **base.typed,
        "Classification": tier_rows,
        "Role": roles_df(spark),
        "Policy": policies.withColumn("source_platform", F.lit(platform)),
        "AccessControlConfig": local_df(
            spark, [("DEFAULT", "role -> CAN_ACCESS -> Classification <- HAS_CLASSIFICATION <- record", "1.0")],
            "name string, check_pattern string, version string").withColumn("created_at", F.lit(run_ts)),
    }
    edges = [base.edges, classified_as(columns, tier_rows),
             role_edges(can_access, inherits), masks(policy_refs, columns, policies)]
    for table, df in entities.items():
        label, key = LABEL_OF[table.upper()], KEY_OF[table.upper()]
        own = (tiers or {}).get(table.upper())
        typed[label] = records(df, table, own, platform, run_ts)
        edges.append(has_classification(typed[label], label, key, tier_rows))
    if "EMPLOYEES" in entities:
        edges.append(reports_to(entities["EMPLOYEES"]))
    if {"CUSTOMERS", "FINANCIAL_TRANSACTIONS"} <= set(entities):
        edges.append(made_transaction(entities["FINANCIAL_TRANSACTIONS"], entities["CUSTOMERS"]))
    return Graph(typed, union_all(edges))


# -- one pass over each source ------------------------------------------------

def _vertex(schema: T.StructType, label: str, properties: bool, key: str | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(vertex_id(label, UNIQUE_KEYS.get(label, "name") if key is None else key).alias("id"), F.array(F.lit(label)).alias("labels"),
                    none.alias("src"), none.alias("dst"), none.alias("type"), (_props(schema) if properties else _no_props()).alias("props"))


def _edge(src: Column, dst: Column, kind: str, exists: Column | None = None) -> Column:
    row = F.struct(F.lit(None).cast("string").alias("id"), F.lit(None).cast("array<string>").alias("labels"), src.alias("src"), dst.alias("dst"),
                   F.lit(kind).alias("type"), _no_props().alias("props"))
    return row if exists is None else F.when(exists, row)


def emitted(df: DataFrame, *rows: Column) -> DataFrame:
    """The graph rows that every row of ``df`` gives: its vertex and its edges."""
    return df.select(F.explode(F.array_compact(F.array(*rows))).alias("_row")).select("_row.*")


def graph_rows(spark: SparkSession, catalog: DataFrame, entities: dict[str, DataFrame],
               policy_refs: DataFrame, run_ts, platform: str = "warehouse",
               database: str = DATABASE, schema: str = SCHEMA,
               can_access: DataFrame | None = None, inherits: DataFrame | None = None,
               tiers: dict[str, dict[str, str]] | None = None, properties: bool = True) -> DataFrame:
    """The graph of ``build_graph`` as one frame (id, labels, src, dst, type, props): vertices have no type, edges no id.

    A source row gives its vertex and its edges in one pass, so every fact is read once. ``properties=False`` leaves the
    property maps empty, for questions about the graph's shape.
    """
    tier_rows = tiers_df(spark)
    known = tier_rows.select(F.col("name").alias("_tier"))

    def with_tier(df: DataFrame) -> DataFrame:
        return df.join(known, df["data_classification"] == F.col("_tier"), "left")

    def vertices_of(df: DataFrame, label: str) -> DataFrame:
        return emitted(df, _vertex(df.schema, label, properties))

    config = local_df(spark, [("DEFAULT", "role -> CAN_ACCESS -> Classification <- HAS_CLASSIFICATION <- record", "1.0")],
                      "name string, check_pattern string, version string").withColumn("created_at", F.lit(run_ts))
    policies = policies_df(spark)
    fixed = [vertices_of(databases_frame(spark, platform, run_ts, database), "Database"), vertices_of(schemas_frame(spark, database, schema), "Schema"),
             vertices_of(tier_rows, "Classification"), vertices_of(roles_df(spark), "Role"), vertices_of(config, "AccessControlConfig"),
             vertices_of(policies.withColumn("source_platform", F.lit(platform)), "Policy")]

    columns = columns_frame(catalog, run_ts, database, schema)
    tables = tables_frame(catalog, run_ts, platform, database, schema)
    schema_id, table_id, column_id = F.lit(f"Schema:{database}.{schema}"), vertex_id("Table", "fqn"), vertex_id("Column", "fqn")
    above = vertex_id("Table", table_fqn("table_name", database, schema))
    tier_id = vertex_id("Classification", "data_classification")
    out = [*fixed,
           emitted(tables, _vertex(tables.schema, "Table", properties), _edge(schema_id, table_id, "CONTAINS_TABLE")),
           emitted(with_tier(columns), _vertex(columns.schema, "Column", properties), _edge(above, column_id, "HAS_COLUMN"),
                   _edge(column_id, tier_id, "CLASSIFIED_AS", F.col("_tier").isNotNull() & (F.col("data_classification") != UNCLASSIFIED)))]
    for table, df in entities.items():
        label, key = LABEL_OF[table.upper()], KEY_OF[table.upper()]
        recs = records(df, table, (tiers or {}).get(table.upper()), platform, run_ts)
        shape, own = recs.schema, vertex_id(label, key)
        rows = [_vertex(shape, label, properties, key), _edge(own, tier_id, "HAS_CLASSIFICATION", F.col("_tier").isNotNull())]
        if table.upper() == "EMPLOYEES":
            # one manager may have a third of all employees: adaptive execution splits that key
            managers = df.select(F.col("employee_id").alias("_manager")).distinct()
            recs = records(df, table, (tiers or {}).get(table.upper()), platform, run_ts, extra=("manager_id",)).join(
                managers, F.col("manager_id") == F.col("_manager"), "left")
            rows.append(_edge(own, vertex_id("Employee", "_manager"), "REPORTS_TO", F.col("_manager").isNotNull()))
        if table.upper() == "FINANCIAL_TRANSACTIONS" and "CUSTOMERS" in entities:
            customers = entities["CUSTOMERS"].select(F.col("customer_id").alias("_customer")).distinct()
            recs = recs.join(customers, F.col("customer_id") == F.col("_customer"), "left")
            rows.append(_edge(vertex_id("Customer", "_customer"), own, "MADE_TRANSACTION", F.col("_customer").isNotNull()))
        out.append(emitted(with_tier(recs), *rows))
    edges = [catalog_edges(spark, catalog.limit(0), database, schema).where(F.col("type") == "CONTAINS_SCHEMA"),
             role_edges(can_access_df(spark) if can_access is None else can_access, inherits_df(spark) if inherits is None else inherits),
             masks(policy_refs, columns, policies)]
    out += [emitted(e, F.struct(F.lit(None).cast("string").alias("id"), F.lit(None).cast("array<string>").alias("labels"), "src", "dst", "type", "props"))
            for e in edges]
    return union_all(out)


def split_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) of graph rows."""
    return rows.where("type is null").select("id", "labels", "props"), rows.where("type is not null").select("src", "dst", "type", "props")


# -- merge and summary -------------------------------------------------------

def merge_vertices(existing: DataFrame, incoming: DataFrame, create_only: tuple[str, ...] = (),
                   counter: str | None = None) -> DataFrame:
    """Upsert by id: incoming properties win, labels are united.

    ``create_only`` properties keep their stored value once set; ``counter`` is a
    property raised by one on every merge (missing counts as 0).
    """
    old, new = existing.alias("o"), incoming.alias("n")
    none = _no_props()
    before = F.coalesce(F.col("o.props"), none)
    after = F.coalesce(F.col("n.props"), none)
    keep = F.array(*map(F.lit, create_only)) if create_only else F.array().cast("array<string>")
    props = F.map_zip_with(before, after, lambda k, a, b: F.when(F.array_contains(keep, k), F.coalesce(a, b))
                           .otherwise(F.coalesce(b, a)))
    if counter is not None:
        raised = (F.coalesce(before[counter].cast("long"), F.lit(0)) + 1).cast("string")
        others = F.map_filter(props, lambda k, v: k != counter)
        props = F.when(F.col("n.id").isNotNull(), F.map_concat(others, F.create_map(F.lit(counter), raised))) \
                 .otherwise(props)
    labels = F.array_union(F.coalesce(F.col("o.labels"), F.array().cast("array<string>")),
                           F.coalesce(F.col("n.labels"), F.array().cast("array<string>")))
    return (old.join(new, F.col("o.id") == F.col("n.id"), "full_outer")
            .select(F.coalesce("o.id", "n.id").alias("id"), labels.alias("labels"), props.alias("props")))


def merge_edges(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert by (src, dst, type): one edge per triple, incoming properties win.

    The key is the whole edge, so a vertex with very many edges is spread over
    all tasks.
    """
    def tagged(df: DataFrame, age: int) -> DataFrame:
        return df.select("src", "dst", "type", F.map_entries("props").alias("entries"), F.lit(age).alias("age"))

    both = tagged(existing, 0).unionByName(tagged(incoming, 1))
    merged = grouped(both, EDGE_KEY).agg(
        F.max(F.when(F.col("age") == 0, F.col("entries"))).alias("a"),
        F.max(F.when(F.col("age") == 1, F.col("entries"))).alias("b"))
    none = _no_props()
    props = F.map_zip_with(F.coalesce(F.map_from_entries("a"), none), F.coalesce(F.map_from_entries("b"), none),
                           lambda k, a, b: F.coalesce(b, a))
    return merged.select("src", "dst", "type", props.alias("props"))


def distinct_edges(edges: DataFrame) -> DataFrame:
    """One edge per (src, dst, type); of several property maps, the largest by its sorted entries."""
    rows = edges.select(*EDGE_KEY, F.array_sort(F.map_entries("props")).alias("_entries"))
    return (grouped(rows, EDGE_KEY).agg(F.max("_entries").alias("_entries"))
            .select(*EDGE_KEY, F.coalesce(F.map_from_entries("_entries"), _no_props()).alias("props")))


def distinct_vertices(vertices: DataFrame) -> DataFrame:
    """One vertex per id: labels united, and of several values of a property the largest."""
    folded = grouped(vertices.select("id", F.explode_outer("labels").alias("_label")), ["id"]).agg(
        F.sort_array(F.collect_set("_label")).alias("labels"))
    repeated = vertices.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("id")
    many = vertices.join(repeated, "id", "left_semi")
    values = (many.select("id", F.explode("props").alias("_key", "_value")).groupBy("id", "_key")
              .agg(F.max("_value").alias("_value")).groupBy("id")
              .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_key", "_value")))).alias("props")))
    merged = (folded.join(repeated, "id", "left_semi").join(values, "id", "left")
              .select("id", "labels", F.coalesce("props", _no_props()).alias("props")))
    return vertices.join(repeated, "id", "left_anti").select("id", "labels", "props").unionByName(merged)


def replace_edges(edges: DataFrame, kind: str, rebuilt: DataFrame) -> DataFrame:
    """Drop every edge of one type and put the re-derived ones in their place."""
    return edges.where(F.col("type") != kind).unionByName(rebuilt)


def ensure_chain(vertices: DataFrame, edges: DataFrame, columns: DataFrame, platform: str, run_ts,
                 database: str = DATABASE, schema: str = SCHEMA) -> tuple[DataFrame, DataFrame]:
    """Add the missing Database -> Schema -> Table chain above ``columns(table_name, ...)``.

    What exists keeps its properties; only absent vertices and edges are added.
    """
    spark = vertices.sparkSession
    chain = union_all([
        as_vertices(databases_frame(spark, platform, run_ts, database), "Database"),
        as_vertices(schemas_frame(spark, database, schema), "Schema"),
        as_vertices(tables_frame(columns, run_ts, platform, database, schema), "Table")])
    links = catalog_edges(spark, columns, database, schema).where(F.col("type") != "HAS_COLUMN")
    absent = chain.join(vertices.select("id"), "id", "left_anti")
    return vertices.unionByName(absent), merge_edges(edges, links)


def label_counts(vertices: DataFrame) -> DataFrame:
    """Vertices per label; a vertex with two labels counts under both."""
    return (vertices.select(F.explode("labels").alias("label"))
            .groupBy("label").agg(F.count(F.lit(1)).alias("n")))


def type_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def graph_summary(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, name, n): counts per label and per edge type, plus both totals."""
    def entry(kind: str, name: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.alias("name"))

    # each side is read once: a few rows per label set or type feed both their own count and the total
    by_labels = vertices.groupBy("labels").agg(F.count(F.lit(1)).alias("n"))
    of_vertices = by_labels.select("n", F.explode(F.array_append(
        F.transform("labels", lambda x: entry("label", x)), entry("total", F.lit("vertices")))).alias("e"))
    of_edges = type_counts(edges).select("n", F.explode(F.array(
        entry("type", F.col("type")), entry("total", F.lit("edges")))).alias("e"))
    none = local_df(vertices.sparkSession, [("total", "vertices", 0), ("total", "edges", 0)], "kind string, name string, n long")
    rows = of_vertices.unionByName(of_edges).select("e.kind", "e.name", "n").unionByName(none)
    return rows.groupBy("kind", "name").agg(F.sum("n").alias("n"))


def row_summary(rows: DataFrame) -> DataFrame:
    """``graph_summary`` of graph rows, in one pass."""
    def entry(kind: str, name: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.alias("name"))

    counted = rows.groupBy("labels", "type").agg(F.count(F.lit(1)).alias("n"))
    names = F.when(F.col("type").isNull(), F.array_append(F.transform("labels", lambda x: entry("label", x)), entry("total", F.lit("vertices")))) \
             .otherwise(F.array(entry("type", F.col("type")), entry("total", F.lit("edges"))))
    none = local_df(rows.sparkSession, [("total", "vertices", 0), ("total", "edges", 0)], "kind string, name string, n long")
    every = counted.select(F.explode(names).alias("e"), "n").select("e.kind", "e.name", "n").unionByName(none)
    return every.groupBy("kind", "name").agg(F.sum("n").alias("n"))


def empty_edges(spark: SparkSession) -> DataFrame:
    return local_df(spark, [], EDGE_SCHEMA)
