"""Governance questions as joins and aggregations.

Inputs are plain frames: ``roles(name, description, hierarchy_level)``,
``can_access(role, classification)``, a column ``catalog`` and record frames with
a ``data_classification``.  Access is direct only: no question follows the role
hierarchy.  Big frames are reduced before they meet roles: records are counted
per (type, tier) first, so a join with roles never multiplies records unless the
question asks for the pairs themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwarden.functions.text import table_fqn
from tierwarden.model import DATABASE, RANKS, SCHEMA, TAG_FIELDS, local_df
from tierwarden.operators import graph as G
from tierwarden.operators import paths as P
from tierwarden.operators.catalog import pivot_tags, tier_rank, union_all
from tierwarden.operators.durable import cut_lineage
from tierwarden.operators.secure import gate_records, project_for_role, secure

DENIED = "ACCESS DENIED: Role does not have permission"
GRANTED = "ACCESS GRANTED"


def _allowed(can_access: DataFrame, role: str, tier: str = "classification") -> DataFrame:
    return can_access.where(F.col("role") == role).select(F.col("classification").alias(tier))


def _of_table(catalog: DataFrame, table: str | None) -> DataFrame:
    return catalog if table is None else catalog.where(F.col("table_name") == table)


def _with_count(df: DataFrame, group: str, name: str) -> DataFrame:
    """``df`` with the rows of each (non-null) group; counts are combined before the shuffle."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias(name))
    return df.join(counts, group)


def _first(df: DataFrame, limit: int | None, *order) -> DataFrame:
    """All rows, or the first ``limit`` in a total order."""
    return df if limit is None else df.orderBy(*order).limit(limit)


# -- roles and tiers -----------------------------------------------------------

def role_tiers(roles: DataFrame, can_access: DataFrame) -> DataFrame:
    """Each role with the tiers it reads, by level.  A role has at most four tiers."""
    held = can_access.groupBy("role").agg(F.sort_array(F.collect_set("classification")).alias("tiers"))
    return (roles.join(held, roles.name == held.role)
            .select("role", F.col("hierarchy_level").alias("level"), "description",
                    F.col("tiers").alias("accessible_classifications"))
            .orderBy("level", "role"))


def roles_for_tier(roles: DataFrame, can_access: DataFrame, tier: str) -> DataFrame:
    """Roles able to read ``tier``, by level."""
    holders = can_access.where(F.col("classification") == tier).select(F.col("role").alias("name"))
    return (roles.join(holders, "name", "left_semi")
            .select(F.col("name").alias("role"), "description", F.col("hierarchy_level").alias("level"))
            .orderBy("level", "role"))


def role_hierarchy(roles: DataFrame, inherits: DataFrame) -> DataFrame:
    """(role, parent): one row per INHERITS_FROM edge, and one with NULL for a role without any.

    Edges are the side that adaptive execution may split when one role has most of
    them; roles without an edge are found against the distinct edge starts.
    """
    links = inherits.select(F.col("parent").alias("role"), F.col("child").alias("parent"))
    names = roles.select(F.col("name").alias("role"))
    linked = links.join(names, "role").select("role", "parent")
    alone = names.join(links.select("role").distinct(), "role", "left_anti")
    return linked.unionByName(alone.withColumn("parent", F.lit(None).cast("string")))


def role_chains(inherits: DataFrame, roots: DataFrame, max_hops: int | None = None) -> DataFrame:
    """Name chain of every path of one or more INHERITS_FROM edges from the given roles."""
    edges = inherits.select(F.col("parent").alias("src"), F.col("child").alias("dst"))
    return P.descend(edges, roots, max_hops).select(F.col("path").alias("role_chain"))


def decide(requests: DataFrame, roles: DataFrame, can_access: DataFrame,
           granted: str = GRANTED, denied: str = DENIED) -> DataFrame:
    """Decision per (role, classification) request; a request of an unknown role gives no row.

    Rights are folded to one row per role first, so the requests meet one small
    side once.
    """
    held = can_access.groupBy("role").agg(F.collect_set("classification").alias("_tiers"))
    known = (roles.select(F.col("name").alias("role")).join(held, "role", "left")
             .withColumn("_tiers", F.coalesce("_tiers", F.array().cast("array<string>"))))
    verdict = F.when(F.array_contains("_tiers", F.col("classification")), F.lit(granted)) \
               .otherwise(F.lit(denied))
    return (requests.join(known, "role")
            .select(*requests.columns, verdict.alias("access_decision"))
            .withColumnRenamed("classification", "classification_requested"))


def decide_one(roles: DataFrame, can_access: DataFrame, role: str, classification: str,
               granted: str = GRANTED, denied: str = DENIED) -> DataFrame:
    """Decision for one role and tier; no row for an unknown role."""
    asked = local_df(roles.sparkSession, [(role, classification)], "role string, classification string")
    return decide(asked, roles, can_access, granted, denied)


# -- records -------------------------------------------------------------------

def record_counts(records: dict[str, DataFrame]) -> DataFrame:
    """(node_type, classification, node_count): at most four rows per record type.

    One aggregation over all types: every task leaves a few partial counts, so
    the shuffle stays tiny however many records there are.
    """
    tiers = union_all([df.select(F.lit(label).alias("node_type"),
                                 F.col("data_classification").alias("classification"))
                       for label, df in records.items()])
    return tiers.groupBy("node_type", "classification").agg(F.count(F.lit(1)).alias("node_count"))


def records_by_tier(records: dict[str, DataFrame]) -> DataFrame:
    """Records by type and tier, most sensitive first."""
    return (record_counts(records).where(F.col("classification").isin(*RANKS))
            .select("node_type", "classification", F.col("node_count").alias("count"),
                    tier_rank("classification").alias("sensitivity_rank"))
            .orderBy("sensitivity_rank", "node_type"))


def visible_by_role(records: dict[str, DataFrame], can_access: DataFrame, role: str | None = None) -> DataFrame:
    """What each role (or one role) can see: record counts by type, and through which tiers."""
    pairs = can_access if role is None else can_access.where(F.col("role") == role)
    return (record_counts(records).join(pairs, "classification")
            .groupBy("role", "node_type")
            .agg(F.sum("node_count").alias("accessible_nodes"),
                 F.sort_array(F.collect_set("classification")).alias("classifications"))
            .orderBy("role", "node_type"))


def accessible_records(recs: DataFrame, can_access: DataFrame, role: str, columns: list[str],
                       order: str | None = None) -> DataFrame:
    """Records of one type the role may see.  ``order`` sorts the result, at the price of a shuffle."""
    out = gate_records(recs, can_access, role).select(*columns, F.lit(role).alias("accessing_as"))
    return out if order is None else out.orderBy(order)


CUSTOMER_LIST = ["customer_id", "first_name", "last_name", "city", "customer_tier", "data_classification"]
TRANSACTION_LIST = ["transaction_id", "merchant_name", "merchant_category", "fraud_flag", "status",
                    "data_classification"]


def denied_sample(records: dict[str, DataFrame], keys: dict[str, str], can_access: DataFrame, role: str,
                  limit: int | None = None) -> DataFrame:
    """(node_type, node_id, classification) of records the role sees, all or the first ``limit``; nothing without access."""
    rows = union_all([
        gate_records(df, can_access, role).select(
            F.lit(label).alias("node_type"), F.col(keys[label]).cast("string").alias("node_id"),
            F.col("data_classification").alias("classification"))
        for label, df in records.items()])
    return _first(rows, limit, "node_type", "node_id")


def masked_sample(df: DataFrame, table: str, role: str, columns: list[str], key: str,
                  limit: int | None = None) -> DataFrame:
    """Rows of a table as a role sees them, all or the first ``limit`` by ``key``: masking in action."""
    return _first(secure(df, table, role).select(columns), limit, key)


HR_FIELDS = {"id": "employee_id", "first_name": "first_name", "last_name": "last_name", "email": "email",
             "department": "department", "job_title": "job_title", "location": "location_office"}
HR_NOTES = {"salary": "[MASKED - Restricted]", "ssn": "[MASKED - Restricted]"}
ENGINEER_FIELDS = {"id": "employee_id", "first_name": "first_name", "last_name": "last_name",
                   "department": "department", "job_title": "job_title"}
ENGINEER_NOTES = {"salary_note": "VISIBLE (Restricted)", "ssn_note": "VISIBLE (Restricted)"}


def hr_employees(employees: DataFrame, can_access: DataFrame, role: str = "HR_MANAGER") -> DataFrame:
    """Empty for HR itself: employee records are Restricted, and HR has no Restricted access."""
    return project_for_role(employees, can_access, role, HR_FIELDS, HR_NOTES)


def engineer_employees(employees: DataFrame, can_access: DataFrame, role: str = "DATA_ENGINEER") -> DataFrame:
    return project_for_role(employees, can_access, role, ENGINEER_FIELDS, ENGINEER_NOTES)


def sensitive_lineage(records: dict[str, DataFrame], can_access: DataFrame,
                      tiers: tuple[str, ...] = ("Restricted",)) -> DataFrame:
    """Record counts per sensitive tier and type, with the roles that reach the tier."""
    holders = (can_access.where(F.col("classification").isin(*tiers))
               .groupBy("classification").agg(F.sort_array(F.collect_set("role")).alias("roles_with_access")))
    return (record_counts(records).where(F.col("classification").isin(*tiers))
            .join(holders, "classification")
            .select("classification", "node_type", "node_count", "roles_with_access")
            .orderBy("classification", "node_type"))


def reachable_transactions(transactions: DataFrame, can_access: DataFrame, role: str,
                           note: str = "Amount masked by amount_masking_policy") -> DataFrame:
    return (record_counts({"Transaction": transactions})
            .join(_allowed(can_access, role), "classification", "left_semi")
            .select(F.lit(role).alias("role"), F.col("node_count").alias("accessible_transactions"),
                    F.col("classification").alias("via_classification"), F.lit(note).alias("note")))


def customer_access_audit(customers: DataFrame, transactions: DataFrame, can_access: DataFrame, role: str,
                          customer_id: int | None = None,
                          note: str = "ACCESSIBLE (amount masked by policy)") -> DataFrame:
    """Transactions reached through customers the role may see, of one customer or of all."""
    seen = gate_records(customers, can_access, role).select(
        "customer_id", F.col("data_classification").alias("classification_granted"))
    made = transactions
    if customer_id is not None:
        seen = seen.where(F.col("customer_id") == customer_id)
        made = made.where(F.col("customer_id") == customer_id)
    made = made.select("customer_id", "transaction_id", F.col("merchant_name").alias("merchant"),
                       F.col("merchant_category").alias("category"))
    return (made.join(seen, "customer_id")
            .select(F.lit(role).alias("role"), "customer_id", "transaction_id", "merchant", "category",
                    F.lit(note).alias("amount_access"), "classification_granted"))


def visible_subgraph(records: dict[str, DataFrame], keys: dict[str, str], can_access: DataFrame,
                     limit: int | None = None) -> DataFrame:
    """(role, classification, node_type, node_id) for every role a record is visible to."""
    nodes = union_all([
        df.select(F.lit(label).alias("node_type"), F.col(keys[label]).cast("string").alias("node_id"),
                  F.col("data_classification").alias("classification"))
        for label, df in records.items()])
    return _first(nodes.join(can_access, "classification")
                  .select("role", "classification", "node_type", "node_id"),
                  limit, "role", "classification", "node_type", "node_id")


def management_paths(employees: DataFrame, max_hops: int = 3) -> DataFrame:
    """Reporting paths of at most ``max_hops`` steps from each employee up to the top.

    The pairs are stored once, since every step of the walk reads them.
    """
    edges = cut_lineage(G.reports_to_pairs(employees).select(F.col("employee_id").alias("src"),
                                                             F.col("manager_id").alias("dst")))
    return P.paths_to_root(employees.select(F.col("employee_id").alias("id")), edges, max_hops)


def customer_transactions(transactions: DataFrame, customers: DataFrame, limit: int | None = None) -> DataFrame:
    """Customer -> transaction pairs of known customers."""
    pairs = transactions.join(customers.select("customer_id"), "customer_id", "left_semi")
    return _first(pairs.select("customer_id", "transaction_id"), limit, "customer_id", "transaction_id")


# -- columns -------------------------------------------------------------------

def column_listing(catalog: DataFrame, table: str | None = None) -> DataFrame:
    """Columns with their tags in table and ordinal order."""
    return (_of_table(catalog, table)
            .select("table_name", "column_name", "data_type", "ordinal_position", *TAG_FIELDS)
            .orderBy("table_name", "ordinal_position"))


def policy_columns(policy_refs: DataFrame, catalog: DataFrame, policies: DataFrame) -> DataFrame:
    """Masking policy -> column, with the column's classification."""
    bound = policy_refs.where(F.col("policy_kind") == "MASKING_POLICY")
    return (bound.join(policies.select(F.col("name").alias("policy_name"), F.col("type").alias("policy_type")),
                       "policy_name")
            .join(catalog.select("table_name", "column_name",
                                 F.col("data_classification").alias("classification")),
                  ["table_name", "column_name"])
            .select(F.col("policy_name").alias("policy"), "policy_type", "table_name", "column_name",
                    "classification")
            .orderBy("table_name", "column_name", "policy"))


def accessible_columns(catalog: DataFrame, can_access: DataFrame, role: str, table: str | None = None) -> DataFrame:
    """Columns the role may read, one row each."""
    return (_of_table(catalog, table)
            .join(_allowed(can_access, role, "data_classification"), "data_classification", "left_semi")
            .select("table_name", "column_name", F.col("data_classification").alias("classification"),
                    "data_owner"))


def accessible_column_lists(catalog: DataFrame, can_access: DataFrame, role: str,
                            table: str | None = None) -> DataFrame:
    """The same with each table's number of such columns."""
    label = F.concat("column_name", F.lit(" ("), "classification", F.lit(")"))
    return (_with_count(accessible_columns(catalog, can_access, role, table), "table_name", "accessible_column_count")
            .select(F.lit(role).alias("role"), "table_name", label.alias("accessible_column"), "accessible_column_count"))


def column_visibility(catalog: DataFrame, can_access: DataFrame, role: str, table: str | None = None) -> DataFrame:
    """VISIBLE or MASKED for every column, whether or not the role reaches it."""
    allowed = _allowed(can_access, role, "data_classification").withColumn("_ok", F.lit(True))
    verdict = F.when(F.col("_ok"), F.lit("VISIBLE")).otherwise(F.lit("MASKED / NO ACCESS"))
    return (_of_table(catalog, table).join(allowed, "data_classification", "left")
            .orderBy("table_name", "ordinal_position")
            .select("table_name", "column_name", F.col("data_classification").alias("classification"),
                    verdict.alias("access_decision"), F.lit(role).alias("role")))


def column_decisions(catalog: DataFrame, can_access: DataFrame, role: str, table: str | None = None) -> DataFrame:
    """How a column the role reaches is shown: unmasked, masked by policy, or blocked."""
    tier = F.col("classification")
    verdict = (F.when(tier.isin("Public", "Internal"), F.lit("VISIBLE - No masking"))
               .when(tier == "Restricted", F.lit("VISIBLE - Masking policy applies"))
               .otherwise(F.lit("BLOCKED")))
    reached = _of_table(catalog, table).join(
        _allowed(can_access, role, "data_classification"), "data_classification", "left_semi")
    return (reached.orderBy("table_name", "ordinal_position")
            .select("table_name", "column_name", F.col("data_classification").alias("classification"))
            .withColumn("access_decision", verdict))


def pii_exposure(catalog: DataFrame, tables: DataFrame | None = None,
                 database: str = DATABASE, schema: str = SCHEMA) -> DataFrame:
    """(table_name, pii_column, pii_column_count): one row for each PII column, most exposed table first.

    With ``tables(fqn, ...)`` only tables known there count; they are matched on
    the name built from the column's table.
    """
    pii = catalog.where(F.col("data_classification") == "PII")
    if tables is not None:
        pii = pii.withColumn("fqn", table_fqn("table_name", database, schema)).join(tables, "fqn", "left_semi")
    return (_with_count(pii.select("table_name", F.col("column_name").alias("pii_column")), "table_name", "pii_column_count")
            .select("table_name", "pii_column", "pii_column_count")
            .orderBy(F.col("pii_column_count").desc(), "table_name", "pii_column"))


def encryption_gaps(catalog: DataFrame, null_is_gap: bool = False) -> DataFrame:
    """Sensitive columns not marked for encryption; optionally an unset flag counts too."""
    gap = F.col("encryption_required") == "No"
    text = "COMPLIANCE RISK: Sensitive column not marked for encryption"
    if null_is_gap:
        gap = gap | F.col("encryption_required").isNull()
        text = "COMPLIANCE RISK: encryption not enforced"
    return (catalog.where(F.col("data_classification").isin("Restricted", "PII") & gap)
            .select("table_name", "column_name", F.col("data_classification").alias("classification"),
                    F.lit(text).alias("warning")))


def owners(catalog: DataFrame, exclude_empty: bool = True) -> DataFrame:
    """(owner_team, owned_column, column_count): one row for each owned column, largest owner first."""
    owned = catalog.where(F.col("data_owner").isNotNull())
    if exclude_empty:
        owned = owned.where(F.col("data_owner") != "")
    named = owned.select(F.col("data_owner").alias("owner_team"),
                         F.concat("table_name", F.lit("."), "column_name").alias("owned_column"))
    return (_with_count(named, "owner_team", "column_count").select("owner_team", "owned_column", "column_count")
            .orderBy(F.col("column_count").desc(), "owner_team", "owned_column"))


def table_column_counts(catalog: DataFrame, database: str = DATABASE, schema: str = SCHEMA) -> DataFrame:
    return (catalog.groupBy("table_name").agg(F.count(F.lit(1)).alias("column_count"))
            .select("table_name", F.concat(F.lit(f"{database}.{schema}."), "table_name").alias("fqn"),
                    "column_count")
            .orderBy("table_name"))


def tier_counts(catalog: DataFrame) -> DataFrame:
    """Columns per tier with its rank, least sensitive first; unknown tiers drop out."""
    return (catalog.where(F.col("data_classification").isin(*RANKS))
            .groupBy(F.col("data_classification").alias("classification"))
            .agg(F.count(F.lit(1)).alias("column_count"))
            .select("classification", tier_rank("classification").alias("sensitivity_rank"), "column_count")
            .orderBy(F.col("sensitivity_rank").desc()))


def tier_columns(catalog: DataFrame, tier: str = "Restricted") -> DataFrame:
    """Columns of one tier with owner, encryption and retention."""
    return (catalog.where(F.col("data_classification") == tier)
            .select("table_name", "column_name", F.col("data_owner").alias("owner_team"),
                    "encryption_required", "retention_policy")
            .orderBy("table_name", "column_name"))


def policy_listing(policies: DataFrame) -> DataFrame:
    """Policies with their (never set) database and schema."""
    none = F.lit(None).cast("string")
    return (policies.select(F.col("name").alias("policy_name"), F.col("type").alias("policy_type"),
                            none.alias("database"), none.alias("schema"))
            .orderBy("policy_type", "policy_name"))


def role_tier_columns(catalog: DataFrame, can_access: DataFrame, tier: str | None = None,
                      limit: int | None = None) -> DataFrame:
    """(role, classification, table, column) for every column a role reaches."""
    cols = catalog.select(F.col("data_classification").alias("classification"), "table_name", "column_name")
    if tier is not None:
        cols = cols.where(F.col("classification") == tier)
    return _first(cols.join(can_access, "classification")
                  .select("role", "classification", "table_name", "column_name"),
                  limit, "role", "table_name", "column_name")


def column_tier_pairs(catalog: DataFrame, limit: int | None = None) -> DataFrame:
    """Column -> tier edges as rows."""
    return _first(catalog.where(F.col("data_classification").isin(*RANKS))
                  .select("table_name", "column_name", F.col("data_classification").alias("classification")),
                  limit, "table_name", "column_name")


def _masked_columns(policy_refs: DataFrame) -> DataFrame:
    return (policy_refs.where(F.col("policy_kind") == "MASKING_POLICY")
            .select("table_name", "column_name", F.col("policy_name").alias("masking_policy")))


def policy_lineage(catalog: DataFrame, policy_refs: DataFrame, can_access: DataFrame, role: str) -> DataFrame:
    """Role -> tier -> column -> policy: which policies guard the columns a role reaches."""
    reached = accessible_columns(catalog, can_access, role)
    return (reached.join(_masked_columns(policy_refs), ["table_name", "column_name"])
            .select(F.lit(role).alias("role"), "classification", "table_name", "column_name", "masking_policy")
            .orderBy("table_name", "column_name", "masking_policy"))


def security_picture(catalog: DataFrame, policy_refs: DataFrame, can_access: DataFrame,
                     limit: int | None = None) -> DataFrame:
    """Role, tier, column and - where there is one - policy.

    Columns meet their policy before they are multiplied by roles.
    """
    cols = catalog.select("table_name", "column_name", F.col("data_classification").alias("classification"))
    guarded = cols.join(_masked_columns(policy_refs), ["table_name", "column_name"], "left")
    return _first(guarded.join(can_access, "classification")
                  .select("role", "classification", "table_name", "column_name", "masking_policy"),
                  limit, "role", "table_name", "column_name", "masking_policy")


def encryption_columns(refs: DataFrame, tables: list[str] | None = None, literal: bool = True) -> DataFrame:
    """Columns tagged encryption_required = 'Yes' with their classification and owner.

    The literal form keeps only that one tag before pivoting the two others, so
    both come out NULL; the other form pivots first.
    """
    of = refs if tables is None else refs.where(F.col("table_name").isin(tables))
    wanted = ("data_classification", "data_owner", "encryption_required")
    if literal:
        of = of.where((F.upper("tag_name") == "ENCRYPTION_REQUIRED") & (F.col("tag_value") == "Yes"))
    wide = pivot_tags(of, fields=wanted)
    return (wide.where(F.col("encryption_required") == "Yes")
            .select("table_name", "column_name", F.col("data_classification").alias("classification"), "data_owner")
            .orderBy("table_name", "column_name"))


def tag_listing(refs: DataFrame, table: str | None = None) -> DataFrame:
    return (_of_table(refs, table).select("table_name", "column_name", "tag_name", "tag_value")
            .orderBy("table_name", "column_name", "tag_name"))
