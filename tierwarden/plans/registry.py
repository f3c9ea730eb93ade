"""Every operator as a named query over a directory of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierwarden.functions.policies import MASKS, ROW_RULES
from tierwarden.model import (
    DATABASE, KEY_OF, LABEL_OF, ROLE_NAMES, SCHEMA, can_access_df, policies_df, roles_df, tiers_df, taxonomy_df,
)
from tierwarden.operators import catalog as C
from tierwarden.operators import drift as D
from tierwarden.operators import graph as G
from tierwarden.operators import paths as P
from tierwarden.operators.durable import scratch_path, write_through
from tierwarden.operators.secure import apply_masks_by_role_column, secure
from tierwarden.operators.sync import CatalogStore, DriftStore, sync_tags
from tierwarden.plans import access as A
from tierwarden.sources import inventory as I
from tierwarden.sources import snapshot as S
from tierwarden.sources.entities import Entities, coerce, minimise, with_provenance
from tierwarden.sources.estate import ORDER, Drifting, Estate, column_of, table_of, pick
from tierwarden.streaming import streams as W

RUN_TS = datetime(2024, 7, 1)
SNAP_TS = datetime(2000, 1, 1)
READERS = ROLE_NAMES + ["ACCOUNTADMIN", "GUEST"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return add


def joined(df: DataFrame, *columns: str) -> DataFrame:
    """Lists as comma-separated text."""
    return df.withColumns({c: F.array_join(c, ",") for c in columns})


def records(spark: SparkSession, sf: str, *labels: str) -> dict[str, DataFrame]:
    """Record frames by label (all five, or the named ones), each with its table's tier."""
    e = Entities(spark, sf)
    return {label: G.records(e.table(t), t, field_lists=False)
            for t, label in LABEL_OF.items() if not labels or label in labels}


def row_tier_records(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Record frames whose tier is that of the columns actually holding a value."""
    return {LABEL_OF[t]: df.withColumn("data_classification", C.record_tier(df, G.sheet_tiers(t)))
            for t, df in Entities(spark, sf).all().items()}


def whole_graph(spark: SparkSession, sf: str, properties: bool = True) -> DataFrame:
    """The rows of the whole governance graph."""
    e, s = Entities(spark, sf), Estate(spark, sf)
    catalog = write_through(s.catalog, scratch_path(spark, "catalog"))
    return G.graph_rows(spark, catalog, e.all(), s.policy_refs, RUN_TS, properties=properties)


KEYS = {LABEL_OF[t]: k for t, k in KEY_OF.items()}


# -- A: sources and sinks ------------------------------------------------------

@query("a01_entity_read")
def _(spark, sf):
    return I.read_entity(spark, f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("a02_tag_refs")
def _(spark, sf):
    return I.tag_refs(Estate(spark, sf).assigned)


@query("a04_table_inventory")
def _(spark, sf):
    names = ["customer", "events", "lineitem", "orders", "part", "supplier"]
    return I.table_inventory(spark, {n: f"{sf}/{n}.parquet" for n in names}).select("table_name", "row_count")


@query("a05_policy_refs")
def _(spark, sf):
    return I.policy_refs(Estate(spark, sf).policy_refs)


@query("a10_label_csv")
def _(spark, sf):
    """Employee vertices written as CSV with a sorted header and read back."""
    e = Entities(spark, sf)
    path = scratch_path(spark, "csv")
    S.export_label_csv(G.as_vertices(minimise(e.employees, "EMPLOYEES"), "Employee"), path)
    header = "id string, department string, email string, employee_id string, employee_number string, " \
             "first_name string, is_active string, job_title string, last_name string, " \
             "location_office string, remote_work string"
    return spark.read.schema(header).option("header", True).option("enforceSchema", False) \
                .csv(f"{path}/nodes_Employee")


@query("a10_entity_csvs")
def _(spark, sf):
    """The vertices of all five governed tables as one CSV folder per label, read back as key=value text."""
    path = scratch_path(spark, "csv")
    typed = {LABEL_OF[t]: minimise(df, t) for t, df in Entities(spark, sf).all().items()}
    frames = []
    for label, columns in S.export_typed_csv(typed, path).items():
        schema = ", ".join(f"`{c}` string" for c in columns)
        back = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(f"{path}/nodes_{label}")
        values = [F.concat(F.lit(f"{c}="), F.col(c)) for c in columns if c != "id"]
        frames.append(back.select(F.lit(label).alias("label"), "id", F.concat_ws("|", *values).alias("properties")))
    return C.union_all(frames)


@query("a11_snapshot_summary")
def _(spark, sf):
    """The summary text written beside a snapshot, read back line by line."""
    path = scratch_path(spark, "summary")
    S.write_summary(G.row_summary(whole_graph(spark, sf, properties=False)), path)
    return spark.read.text(f"{path}/summary").select(F.col("value").alias("line"))


def _round_trip(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The whole graph stored, exported as JSON Lines, and imported again."""
    path = scratch_path(spark, "snapshot")
    S.export_snapshot(*S.store_rows(whole_graph(spark, sf), f"{path}/graph"), path)
    return S.import_snapshot(spark, path)


@query("a12_round_trip_edges")
def _(spark, sf):
    """The edges that come back, row by row."""
    return _round_trip(spark, sf)[1].select("src", "dst", "type", F.size("props").alias("n_props"))


@query("a12_round_trip_vertices")
def _(spark, sf):
    """The vertices that come back, row by row, with their catalog properties."""
    props = F.col("props")
    return _round_trip(spark, sf)[0].select("id", F.array_join("labels", ",").alias("labels"), *[
        F.when(F.array_contains("labels", "Column"), props[f]).alias(f) for f in ("data_classification", "data_owner", "ordinal_position")])


@query("a10_graph_csvs")
def _(spark, sf):
    """All thirteen labels of the graph as CSV from one job, read back: header, id and, for catalog labels and records, all values."""
    e, s = Entities(spark, sf), Estate(spark, sf)
    catalog = write_through(s.catalog, scratch_path(spark, "catalog"))
    typed = G.build_graph(spark, catalog, {}, s.policy_refs, RUN_TS).typed | {
        LABEL_OF[t]: minimise(df, t) for t, df in e.all().items()}
    path, frames = scratch_path(spark, "csv"), []
    for label, columns in S.export_graph_csv(typed, path).items():
        schema = ", ".join(f"`{c}` string" for c in columns)
        back = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True)
                .csv(f"{path}/label={label}"))
        values = F.concat_ws("|", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in columns if c != "id"])
        shown = label in ("Column", "Table", "Schema", "Database", *LABEL_OF.values())
        frames.append(back.select(F.lit(label).alias("label"), "id", F.lit(",".join(columns)).alias("header"),
                                  (values if shown else F.lit(None).cast("string")).alias("properties")))
    return C.union_all(frames)


def _contacts(spark: SparkSession, sf: str) -> tuple[tuple[DataFrame, DataFrame], str]:
    """A stored graph of customers, and the snapshot of another one that names them by one of three business keys.

    One order in 61 gives the number of its customer and the mail of the next one, so that the two turn out to be the same.
    """
    raw = Estate(spark, sf).raw
    c, o, k = raw("customer"), raw("orders"), F.col("o_custkey")

    def text(x):
        return x.cast("string")

    def mail(x):
        return F.concat(F.lit("c"), text(x), F.lit("@mail"))

    def phone(x):
        return F.concat(F.lit("+"), F.lpad(text(x), 12, "0"))

    own = F.col("c_custkey")
    stored = c.select(F.concat(F.lit("Customer:"), text(own)).alias("id"), F.array(F.lit("Customer")).alias("labels"),
                      F.create_map(F.lit("customer_id"), text(own), F.lit("email"), mail(own), F.lit("phone"), phone(own),
                                   F.lit("segment"), F.col("c_mktsegment")).alias("props"))
    edges = c.select(F.concat(F.lit("Customer:"), text(own)).alias("src"), F.concat(F.lit("Nation:"), text(F.col("c_nationkey"))).alias("dst"),
                     F.lit("LIVES_IN").alias("type"), F.create_map().cast("map<string,string>").alias("props"))
    n, both = F.col("o_orderkey"), F.col("o_orderkey") % 61 == 0
    props = F.map_filter(F.create_map(
        F.lit("customer_id"), F.when(both | (n % 3 == 0), text(k)), F.lit("email"), F.when(both, mail(k + 1)).when(n % 3 == 1, mail(k)),
        F.lit("phone"), F.when(~both & (n % 3 == 2), phone(k)), F.lit("contact"), F.lpad(text(n), 12, "0")), lambda _, v: v.isNotNull())
    there = o.select(F.concat(F.lit("crm:"), text(n)).alias("id"), F.array(F.lit("Customer"), F.lit("Contact")).alias("labels"), props.alias("props"))
    orders = o.select(F.concat(F.lit("order:"), text(n)).alias("id"), F.array(F.lit("Order")).alias("labels"),
                      F.create_map(F.lit("status"), F.col("o_orderstatus")).alias("props"))
    placed = o.select(F.concat(F.lit("crm:"), text(n)).alias("src"), F.concat(F.lit("order:"), text(n)).alias("dst"), F.lit("PLACED").alias("type"),
                      F.create_map().cast("map<string,string>").alias("props"))
    path = scratch_path(spark, "contacts")
    S.export_snapshot(there.unionByName(orders), placed, path)
    return (stored, edges), path


IDENTITY = {"Customer": ["customer_id", "email", ("phone",)]}


@query("j12_resolved_vertices")
def _(spark, sf):
    """A snapshot of another graph imported by business keys: the customers that are left, and their values."""
    existing, path = _contacts(spark, sf)
    vertices, _ = S.import_snapshot(spark, path, existing, keys=IDENTITY)
    return vertices.where(F.array_contains("labels", "Customer")).select(
        "id", F.array_join("labels", ",").alias("labels"),
        *[F.col("props")[p].alias(p) for p in ("customer_id", "email", "phone", "segment", "contact")])


@query("j12_resolved_edges")
def _(spark, sf):
    """The edges of both graphs at the surviving customers."""
    existing, path = _contacts(spark, sf)
    return S.import_snapshot(spark, path, existing, keys=IDENTITY)[1].select("src", "dst", "type")


@query("a12_snapshot_round_trip")
def _(spark, sf):
    """Whole graph stored, exported as JSON Lines, imported again, and counted."""
    return G.graph_summary(*_round_trip(spark, sf))


@query("a12_snapshot_typed")
def _(spark, sf):
    """Product vertices through export and import, restored to their types."""
    products = minimise(Entities(spark, sf).products, "PRODUCTS")
    path = scratch_path(spark, "snapshot")
    vertices = G.as_vertices(products, "Product")
    S.export_snapshot(vertices, G.empty_edges(spark), path)
    back, _edges = S.import_snapshot(spark, path, existing=(vertices, G.empty_edges(spark)))
    return G.from_vertices(back, "Product", products.schema)


# -- B: taxonomy, assignment, checks -------------------------------------------

@query("b01_tag_violations")
def _(spark, sf):
    return C.validate_tags(Estate(spark, sf).assigned, taxonomy_df(spark))


@query("b02_assigned_tags")
def _(spark, sf):
    return Estate(spark, sf).assigned


@query("b03_defaults")
def _(spark, sf):
    k = F.col("customer_id")
    given = Entities(spark, sf).customers.select(
        k, F.when(k % 7 != 0, F.col("country")).alias("country"),
        F.when(k % 3 != 0, F.col("created_at")).alias("created_at"),
        F.when(k % 5 != 0, F.col("is_active")).alias("is_active"))
    return C.apply_defaults(given, "CUSTOMERS", RUN_TS).withColumn("created_at", F.col("created_at").cast("string"))


@query("b04_duplicate_keys")
def _(spark, sf):
    e = Entities(spark, sf)
    checks = [C.check_unique(df, KEY_OF[t]).select(F.lit(t).alias("table_name"), "key_value", "rows")
              for t, df in e.all().items()]
    checks.append(C.check_unique(e.transactions, "account_number")
                  .select(F.lit("ACCOUNTS").alias("table_name"), "key_value", "rows"))
    return C.union_all(checks)


@query("b05_null_columns")
def _(spark, sf):
    e = Entities(spark, sf)
    return C.union_all([
        C.check_not_null(e.customers, "CUSTOMERS", ["customer_id", "email", "ssn", "address_line2"]),
        C.check_not_null(e.employees, "EMPLOYEES", ["employee_id", "manager_id", "termination_date"]),
        C.check_not_null(e.transactions, "FINANCIAL_TRANSACTIONS"),
        C.check_not_null(e.audit_logs, "AUDIT_LOGS", ["log_id", "user_email", "failure_reason"])])


@query("b06_normalised_refs")
def _(spark, sf):
    return C.normalise_refs(Estate(spark, sf).assigned)


# -- C: minimising projections -------------------------------------------------

@query("c04_coerced_values")
def _(spark, sf):
    """Text columns cast to the model's types; what does not parse becomes NULL."""
    e = Entities(spark, sf)
    return coerce(e.raw("orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("level"),
                                         F.col("o_orderstatus").alias("code")), {"level": "int", "code": "long"})


@query("c07_provenance")
def _(spark, sf):
    out = with_provenance(minimise(Entities(spark, sf).customers, "CUSTOMERS"), "customers", "warehouse", RUN_TS)
    return out.select("customer_id", "source_table", "source_platform", F.col("ingested_at").cast("string").alias("ingested_at"))


def _minimised(table: str) -> Query:
    return lambda spark, sf: minimise(Entities(spark, sf).table(table), table)


for _t in LABEL_OF:
    QUERIES[f"c06_minimise_{_t.lower()}"] = _minimised(_t)


# -- D/E: masked and row-filtered reads ----------------------------------------

SECURED = {
    "CUSTOMERS": ["customer_id", "email", "ssn", "city", "is_active"],
    "EMPLOYEES": ["employee_id", "first_name", "last_name", "email", "personal_email", "ssn", "salary", "bonus"],
    "FINANCIAL_TRANSACTIONS": ["transaction_id", "customer_id", "account_number", "transaction_amount",
                               "ip_address", "fraud_flag"],
    "AUDIT_LOGS": ["log_id", "user_email", "source_ip", "action_type"],
}
SECURED_READS = [
    ("CUSTOMERS", "DATA_ANALYST"), ("CUSTOMERS", "HR_MANAGER"),
    ("EMPLOYEES", "DATA_ENGINEER"), ("EMPLOYEES", "HR_MANAGER"), ("EMPLOYEES", "DATA_ANALYST"),
    ("FINANCIAL_TRANSACTIONS", "DATA_ANALYST"), ("FINANCIAL_TRANSACTIONS", "FINANCE_ANALYST"),
    ("FINANCIAL_TRANSACTIONS", "GUEST"), ("AUDIT_LOGS", "SECURITY_AUDITOR"), ("AUDIT_LOGS", "FINANCE_ANALYST"),
]


def _secured(table: str, role: str) -> Query:
    return lambda spark, sf: secure(Entities(spark, sf).table(table), table, role).select(SECURED[table])


for _t, _r in SECURED_READS:
    QUERIES[f"e05_secure_{_t.lower()}_{_r.lower()}"] = _secured(_t, _r)


@query("d08_masks_by_role_column")
def _(spark, sf):
    """Audit rows, each masked for the role of its own reader."""
    with_role = Entities(spark, sf).audit_logs.withColumn(
        "reader_role", pick(F.col("records_accessed") % len(READERS), READERS))
    return (apply_masks_by_role_column(with_role, "AUDIT_LOGS", "reader_role")
            .select("log_id", "reader_role", "user_email", "source_ip"))


def _totals(df: DataFrame, rule: str, rule_column: str, mask: str, mask_column: str) -> DataFrame:
    """Visible rows and masked total for every reader role, in one pass over the table."""
    sees = {r: ROW_RULES[rule](rule_column, r) for r in READERS}
    shown = {r: MASKS[mask](mask_column, r).try_cast("decimal(12,2)") for r in READERS}
    aggs: list[Column] = []
    for r in READERS:
        aggs.append(F.struct(F.lit(r).alias("role"), F.count_if(sees[r]).alias("visible_rows"),
                             F.sum(F.when(sees[r], shown[r])).cast("decimal(22,2)").alias("total"))
                    .alias(r))
    return df.agg(*aggs).select(F.explode(F.array(*READERS)).alias("x")).select("x.*")


@query("e05_masked_amount_totals")
def _(spark, sf):
    return _totals(Entities(spark, sf).transactions, "TRANSACTION_FRAUD_POLICY", "fraud_flag",
                   "AMOUNT_MASKING_POLICY", "transaction_amount")


@query("e05_masked_salary_totals")
def _(spark, sf):
    return _totals(Entities(spark, sf).employees, "EMPLOYEE_ROW_POLICY", "termination_date",
                   "SALARY_MASKING_POLICY", "salary")


@query("e10_bulk_decisions")
def _(spark, sf):
    return A.decide(Estate(spark, sf).requests, roles_df(spark), can_access_df(spark))


@query("e10_decision_counts")
def _(spark, sf):
    """Decisions per role and tier; requests are counted before they are judged."""
    asked = Estate(spark, sf).requests.groupBy("role", "classification").agg(F.count(F.lit(1)).alias("requests"))
    return A.decide(asked, roles_df(spark), can_access_df(spark), "GRANTED", "DENIED")


# -- G: aggregations -----------------------------------------------------------

@query("g01_pivot_tags")
def _(spark, sf):
    return C.pivot_tags(Estate(spark, sf).assigned)


@query("g01_column_catalog")
def _(spark, sf):
    return Estate(spark, sf).catalog


@query("g02_tier_coverage")
def _(spark, sf):
    return C.tier_coverage(Estate(spark, sf).tags)


@query("g08_governed_table_count")
def _(spark, sf):
    s = Estate(spark, sf)
    found = C.discover_governed_tables(I.tag_refs(s.assigned), s.policy_refs)
    return found.agg(F.count(F.lit(1)).alias("governed_tables"))


@query("g10_table_tier")
def _(spark, sf):
    return C.rollup_classification(Estate(spark, sf).catalog, overrides={})


@query("g11_row_tier_counts")
def _(spark, sf):
    return A.record_counts(row_tier_records(spark, sf))


@query("j02_governed_tables")
def _(spark, sf):
    s = Estate(spark, sf)
    return C.discover_governed_tables(I.tag_refs(s.assigned), s.policy_refs)


# -- J: drift and sync ---------------------------------------------------------

@query("j03_tag_diff")
def _(spark, sf):
    s = Drifting(spark, sf)
    return D.diff_tags(D.with_fqn(s.incoming_catalog), D.with_fqn(s.stored_catalog))


@query("j03_tag_diff_full")
def _(spark, sf):
    """No false encryption changes, and removed columns reported."""
    s = Drifting(spark, sf)
    return D.diff_tags(D.with_fqn(s.incoming_catalog), D.with_fqn(s.stored_catalog),
                       empty_equivalents={"data_classification": "Unclassified", "encryption_required": "No"},
                       include_removed=True)


@query("j03_diff_summary")
def _(spark, sf):
    s = Drifting(spark, sf)
    return D.diff_summary(D.diff_tags(D.with_fqn(s.incoming_catalog), D.with_fqn(s.stored_catalog),
                                      include_removed=True))


def _snapshot(s: Estate) -> DataFrame:
    return s.old_tags.select(F.xxhash64(*C.KEY).alias("snapshot_id"), "*",
                             F.lit(SNAP_TS).cast("timestamp").alias("captured_at"))


@query("j04_tag_changes")
def _(spark, sf):
    s = Drifting(spark, sf)
    return D.detect_tag_changes(s.tags, _snapshot(s), RUN_TS).select(
        *C.KEY, "tag_field", "old_value", "new_value", "sync_status")


@query("j05_snapshot_refresh")
def _(spark, sf):
    """The stored snapshot refreshed with what is live now: the new rows are added as a part, and the table is merged as it is read."""
    s = Drifting(spark, sf)
    table = DriftStore(spark, scratch_path(spark, "drift")).snapshot
    table.upsert(_snapshot(s))
    live = s.tags.join(s.live_inventory.select(C.KEY), C.KEY, "left_semi")
    table.upsert(D.snapshot_rows(live, RUN_TS), merge=False)
    return table.read().withColumn("refreshed", F.col("captured_at") == F.lit(RUN_TS)).drop("snapshot_id", "captured_at")


@query("j06_merged_vertices")
def _(spark, sf):
    """Stored column vertices upserted with the incoming ones; the version counter rises by one."""
    s = Drifting(spark, sf)

    def columns(catalog: DataFrame) -> DataFrame:
        return G.as_vertices(D.with_fqn(catalog).select("fqn", "data_classification", "data_owner"), "Column")

    stored, incoming = columns(s.stored_catalog), columns(C.fill_tag_defaults(s.incoming_catalog, trim=True))
    merged = G.merge_vertices(stored, incoming, create_only=("data_owner",), counter="sync_version")
    return merged.select("id", F.col("props")["data_classification"].alias("data_classification"),
                         F.col("props")["data_owner"].alias("data_owner"),
                         F.col("props")["sync_version"].alias("sync_version"))


@query("j07_merged_edges")
def _(spark, sf):
    """CLASSIFIED_AS edges of the stored catalog merged with those of the incoming one."""
    s, tiers = Drifting(spark, sf), tiers_df(spark)

    def edges(catalog: DataFrame) -> DataFrame:
        return G.classified_as(G.columns_frame(catalog, RUN_TS), tiers)

    merged = G.merge_edges(edges(s.stored_catalog), edges(C.fill_tag_defaults(s.incoming_catalog, trim=True)))
    return merged.select("src", "dst", "type")


def _synced(spark: SparkSession, sf: str) -> CatalogStore:
    """A store after two sync cycles: snapshot state, then now."""
    s = Drifting(spark, sf)
    store = CatalogStore(spark, scratch_path(spark, "store"))
    sync_tags(C.column_catalog(s.old_tags, s.inventory), store, run_ts=SNAP_TS)
    sync_tags(s.incoming_catalog, store, changed_only=True, run_ts=RUN_TS,
              empty_equivalents={"data_classification": "Unclassified", "encryption_required": "No"})
    return store


@query("j10_sync_result")
def _(spark, sf):
    """The stored catalog after two sync cycles."""
    return _synced(spark, sf).catalog.read().select(
        "fqn", "data_classification", "data_category", "encryption_required", "retention_policy", "data_owner", "sync_version")


@query("j10_synced_edges")
def _(spark, sf):
    """The stored edges by type after the same cycles."""
    return G.type_counts(_synced(spark, sf).edges.read())


@query("j10_synced_chain")
def _(spark, sf):
    """The stored Database, Schema and Table vertices after the same cycles."""
    return _synced(spark, sf).vertices.read().select("id", F.array_join("labels", ",").alias("labels"))


@query("j11_pending_changes")
def _(spark, sf):
    """Pending changes of a log whose older half has been marked as synced."""
    s = Drifting(spark, sf)
    old = D.mark_synced(D.detect_tag_changes(s.old_tags, _snapshot(s).limit(0), SNAP_TS), SNAP_TS)
    log = old.unionByName(D.detect_tag_changes(s.tags, _snapshot(s), RUN_TS))
    return D.pending_changes(log).drop("changed_at")


@query("j11_column_history")
def _(spark, sf):
    """When each value of every column's tags held, from the statements."""
    s = Estate(spark, sf)
    return (D.tag_intervals(_statements(s), ORDER)
            .withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")}))


@query("j11_catalog_at")
def _(spark, sf):
    """The tags of every column as they were when each delivery of its part was received."""
    s = Estate(spark, sf)
    moments = s.raw("lineitem").select(table_of("l_partkey").alias("table_name"), column_of("l_partkey").alias("column_name"),
                                       F.date_trunc("quarter", F.col("l_shipdate")).cast("timestamp_ntz").alias("moment"))
    return D.catalog_at(D.tag_intervals(_statements(s), ORDER), moments).withColumn("moment", F.col("moment").cast("string"))


def _statements(s: Estate) -> DataFrame:
    return s.history.select(*C.KEY, F.upper("tag_name").alias("tag_field"), F.col("tag_value").alias("value"), *ORDER)


# -- K: graph construction -----------------------------------------------------

@query("k11_graph_summary")
def _(spark, sf):
    return G.row_summary(whole_graph(spark, sf, properties=False))


@query("k01_catalog_edges")
def _(spark, sf):
    return G.catalog_edges(spark, Estate(spark, sf).catalog).select("src", "dst", "type")


@query("k04_classified_as")
def _(spark, sf):
    columns = G.columns_frame(Estate(spark, sf).catalog, RUN_TS)
    return G.classified_as(columns, tiers_df(spark)).select("src", "dst", "type")


def _record_vertices(table: str, *lists: str) -> Query:
    return lambda spark, sf: joined(G.records(Entities(spark, sf).table(table), table), *lists)


QUERIES["k05_customer_records"] = _record_vertices("CUSTOMERS", "pii_fields", "restricted_fields")
QUERIES["k06_employee_records"] = _record_vertices("EMPLOYEES", "pii_fields", "restricted_fields")
QUERIES["k07_product_records"] = _record_vertices("PRODUCTS", "public_fields", "restricted_fields")
QUERIES["k08_transaction_records"] = _record_vertices("FINANCIAL_TRANSACTIONS", "restricted_fields")
QUERIES["k09_audit_records"] = _record_vertices("AUDIT_LOGS")


@query("k06_reports_to")
def _(spark, sf):
    return G.reports_to(Entities(spark, sf).employees).select("src", "dst", "type")


@query("k08_made_transaction")
def _(spark, sf):
    e = Entities(spark, sf)
    return G.made_transaction(e.transactions, e.customers).select("src", "dst", "type")


@query("k08_has_classification")
def _(spark, sf):
    recs = records(spark, sf, "Transaction")["Transaction"]
    return G.has_classification(recs, "Transaction", "transaction_id", tiers_df(spark)).select("src", "dst", "type")


@query("k10_masks")
def _(spark, sf):
    s = Estate(spark, sf)
    return G.masks(s.policy_refs, G.columns_frame(s.catalog, RUN_TS), policies_df(spark)).select("src", "dst", "type")


# -- M: governance questions ---------------------------------------------------

@query("m01_role_tiers")
def _(spark, sf):
    s = Estate(spark, sf)
    return joined(A.role_tiers(s.teams, s.team_access), "accessible_classifications")


@query("m02_records_by_tier")
def _(spark, sf):
    return A.records_by_tier(records(spark, sf))


@query("m03_column_listing")
def _(spark, sf):
    return A.column_listing(Estate(spark, sf).catalog)


@query("m04_policy_columns")
def _(spark, sf):
    s = Estate(spark, sf)
    return A.policy_columns(s.policy_refs, s.catalog, policies_df(spark))


@query("m05_visible_by_role")
def _(spark, sf):
    return joined(A.visible_by_role(records(spark, sf), can_access_df(spark)), "classifications")


@query("m05_visible_by_role_row_tier")
def _(spark, sf):
    return joined(A.visible_by_role(row_tier_records(spark, sf), can_access_df(spark)), "classifications")


@query("m06_customer_list")
def _(spark, sf):
    return A.accessible_records(records(spark, sf, "Customer")["Customer"], can_access_df(spark), "FINANCE_ANALYST",
                                A.CUSTOMER_LIST)


@query("m07_transaction_list")
def _(spark, sf):
    return A.accessible_records(records(spark, sf, "Transaction")["Transaction"], can_access_df(spark), "FINANCE_ANALYST",
                                A.TRANSACTION_LIST)


@query("m08_visible_sample")
def _(spark, sf):
    return A.denied_sample(records(spark, sf), KEYS, can_access_df(spark), "DATA_ANALYST")


@query("m09_accessible_columns")
def _(spark, sf):
    return A.accessible_columns(Estate(spark, sf).catalog, can_access_df(spark), "HR_MANAGER")


@query("m09_accessible_column_lists")
def _(spark, sf):
    return A.accessible_column_lists(Estate(spark, sf).catalog, can_access_df(spark), "HR_MANAGER")


@query("m10_column_visibility")
def _(spark, sf):
    return A.column_visibility(Estate(spark, sf).catalog, can_access_df(spark), "HR_MANAGER")


@query("m11_engineer_employees")
def _(spark, sf):
    return A.engineer_employees(records(spark, sf, "Employee")["Employee"], can_access_df(spark))


@query("m12_column_decisions")
def _(spark, sf):
    return A.column_decisions(Estate(spark, sf).catalog, can_access_df(spark), "FINANCE_ANALYST")


@query("m13_role_chains")
def _(spark, sf):
    s = Estate(spark, sf)
    tree = s.team_tree
    tops = tree.select(F.col("parent").alias("id")).distinct().join(
        tree.select(F.col("child").alias("id")), "id", "left_anti")
    return joined(A.role_chains(tree, tops), "role_chain")


@query("m14_roles_for_tier")
def _(spark, sf):
    s = Estate(spark, sf)
    return A.roles_for_tier(s.teams, s.team_access, "Restricted")


@query("m16_sensitive_lineage")
def _(spark, sf):
    return joined(A.sensitive_lineage(records(spark, sf), can_access_df(spark)), "roles_with_access")


@query("m16_sensitive_lineage_row_tier")
def _(spark, sf):
    out = A.sensitive_lineage(row_tier_records(spark, sf), can_access_df(spark), ("Restricted", "PII"))
    return joined(out, "roles_with_access")


@query("m17_pii_exposure")
def _(spark, sf):
    return A.pii_exposure(Estate(spark, sf).catalog)


@query("m18_encryption_gaps")
def _(spark, sf):
    return A.encryption_gaps(Estate(spark, sf).catalog)


@query("m18_encryption_gaps_null")
def _(spark, sf):
    s = Estate(spark, sf)
    return A.encryption_gaps(C.column_catalog(s.tags, s.inventory), null_is_gap=True)


def _owners(exclude_empty: bool) -> Query:
    return lambda spark, sf: A.owners(Estate(spark, sf).catalog, exclude_empty)


QUERIES["m19_owners"] = _owners(True)
QUERIES["m19_owners_with_empty"] = _owners(False)


@query("m20_customer_access_audit")
def _(spark, sf):
    r = records(spark, sf, "Customer", "Transaction")
    return A.customer_access_audit(r["Customer"], r["Transaction"], can_access_df(spark), "FINANCE_ANALYST")


@query("m21_visible_subgraph")
def _(spark, sf):
    return A.visible_subgraph(records(spark, sf, "Customer", "Employee"), KEYS, can_access_df(spark))


@query("m21_column_tier_pairs")
def _(spark, sf):
    return A.column_tier_pairs(Estate(spark, sf).catalog)


@query("m22_management_paths")
def _(spark, sf):
    paths = A.management_paths(Entities(spark, sf).employees)
    return paths.select("start", F.array_join(F.transform("path", lambda x: x.cast("string")), ",").alias("path"),
                        "hops")


@query("m23_customer_transactions")
def _(spark, sf):
    e = Entities(spark, sf)
    return A.customer_transactions(e.transactions, e.customers)


@query("m24_catalog_paths")
def _(spark, sf):
    return joined(P.catalog_paths(Estate(spark, sf).catalog, DATABASE, SCHEMA), "path")


@query("m24_table_column_counts")
def _(spark, sf):
    return A.table_column_counts(Estate(spark, sf).catalog)


@query("m25_tier_counts")
def _(spark, sf):
    return A.tier_counts(Estate(spark, sf).catalog)


@query("m26_restricted_columns")
def _(spark, sf):
    return A.tier_columns(Estate(spark, sf).catalog)


@query("m28_role_hierarchy")
def _(spark, sf):
    s = Estate(spark, sf)
    return A.role_hierarchy(s.teams, s.team_tree)


@query("m29_role_restricted_columns")
def _(spark, sf):
    return A.role_tier_columns(Estate(spark, sf).catalog, can_access_df(spark), "Restricted")


@query("m30_reachable_transactions")
def _(spark, sf):
    return A.reachable_transactions(records(spark, sf, "Transaction")["Transaction"], can_access_df(spark), "FINANCE_ANALYST")


@query("m31_policy_lineage")
def _(spark, sf):
    s = Estate(spark, sf)
    return A.policy_lineage(s.catalog, s.policy_refs, can_access_df(spark), "FINANCE_ANALYST")


@query("m32_security_picture")
def _(spark, sf):
    s = Estate(spark, sf)
    return A.security_picture(s.catalog, s.policy_refs, can_access_df(spark))


@query("m33_encryption_columns")
def _(spark, sf):
    return A.encryption_columns(Estate(spark, sf).assigned)


@query("m33_encryption_columns_pivoted")
def _(spark, sf):
    return A.encryption_columns(Estate(spark, sf).assigned, literal=False)


@query("m34_tag_listing")
def _(spark, sf):
    return A.tag_listing(I.short_refs(I.tag_refs(Estate(spark, sf).assigned)))


def _sample(role: str) -> Query:
    columns = ["employee_id", "first_name", "last_name", "email", "ssn", "salary"]
    return lambda spark, sf: A.masked_sample(Entities(spark, sf).employees, "EMPLOYEES", role, columns, "employee_id")


for _r in ("DATA_ENGINEER", "HR_MANAGER", "DATA_ANALYST"):
    QUERIES[f"m35_masked_sample_{_r.lower()}"] = _sample(_r)


@query("m17_pii_exposure_known_tables")
def _(spark, sf):
    """Exposure of the tables that carry an active policy, matched on their qualified name."""
    s = Estate(spark, sf)
    known = s.policy_refs.where(F.col("policy_status") == "ACTIVE").select(
        F.concat(F.lit(f"{DATABASE}.{SCHEMA}."), "table_name").alias("fqn")).distinct()
    return A.pii_exposure(s.catalog, known)


# -- N: streaming --------------------------------------------------------------

def _arriving(spark: SparkSession, sf: str, path: str, deliveries: int, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """SET TAG statements arriving as so many ``deliveries`` (by order number, so many come late), each drained by a restarted stream."""
    lines = Estate(spark, sf).raw("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")      # what a statement is made of
    for n in range(deliveries):
        lines.where(F.col("l_orderkey") % deliveries == n).write.mode("append").parquet(f"{path}/statements")
        start(Estate.history_of(W.read_files(spark, f"{path}/statements", lines.schema))).awaitTermination()


@query("n01_stream_sync")
def _(spark, sf):
    """SET TAG statements streamed into the catalog store; the stored catalog afterwards."""
    path, inventory = scratch_path(spark, "stream-sync"), Estate(spark, sf).inventory
    _arriving(spark, sf, path, 5, lambda statements: W.stream_tag_sync(statements, path, ORDER, inventory))
    return CatalogStore(spark, path).catalog.read().select(
        "fqn", "data_classification", "data_category", "encryption_required", "retention_policy", "data_owner")


@query("n02_stream_drift")
def _(spark, sf):
    """SET TAG statements streamed into the drift job; the whole change log, removed tags included."""
    path = scratch_path(spark, "stream-drift")
    _arriving(spark, sf, path, 10, lambda statements: W.stream_detect_changes(
        statements, path, ORDER, run_ts=lambda batch: RUN_TS + timedelta(minutes=batch)))
    return DriftStore(spark, path).log.read().select(
        F.col("changed_at").cast("string").alias("changed_at"), *C.KEY, "tag_field", "old_value", "new_value", "sync_status")


@query("n03_stream_secure")
def _(spark, sf):
    """Audit rows secured as they arrive."""
    path = scratch_path(spark, "stream-secure")
    events = W.read_files(spark, sf, Entities(spark, sf).raw("events").schema, "events.parquet")
    logs = Entities.audit_logs_of(events)
    W.stream_secure(logs, "AUDIT_LOGS", "DATA_ANALYST", f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(logs.schema).parquet(f"{path}/rows").select(SECURED["AUDIT_LOGS"])
