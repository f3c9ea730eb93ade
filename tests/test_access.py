"""Golden answers on the ten-row fixture."""

from pyspark.sql import functions as F

from tierwarden.model import ROLE_NAMES, inherits_df, local_df
from tierwarden.operators import paths as P
from tierwarden.plans import access as A

KEYS = {"Customer": "customer_id", "Employee": "employee_id", "Product": "product_id",
        "Transaction": "transaction_id", "AuditLog": "log_id"}


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_role_tiers(fixture):
    found = A.role_tiers(fixture.roles, fixture.access).collect()
    assert [r.role for r in found][:2] == ["DATA_GOVERNANCE_ADMIN", "DATA_ENGINEER"]
    assert len(found) == 7 and sum(len(r.accessible_classifications) for r in found) == 19


def test_records_by_tier(fixture):
    assert rows(A.records_by_tier(fixture.records)) == [
        ("Customer", "Restricted", 10, 1), ("Employee", "Restricted", 10, 1), ("Product", "Restricted", 10, 1),
        ("Transaction", "Restricted", 10, 1), ("AuditLog", "Internal", 10, 3)]


def test_visible_by_role(fixture):
    def seen(role):
        return {r.node_type: r.accessible_nodes for r in
                A.visible_by_role(fixture.records, fixture.access, role).collect()}
    assert seen("DATA_ANALYST") == {"AuditLog": 10}
    assert seen("DATA_ENGINEER") == dict.fromkeys(KEYS, 10)
    assert seen("PUBLIC_USER") == {}


def test_record_lists(fixture):
    def customers(role):
        return A.accessible_records(fixture.records["Customer"], fixture.access, role, A.CUSTOMER_LIST,
                                    order="customer_id").collect()
    for role in ("DATA_ANALYST", "HR_MANAGER", "PUBLIC_USER"):
        assert customers(role) == []
    for role in ("FINANCE_ANALYST", "DATA_ENGINEER"):
        assert [r.customer_id for r in customers(role)] == list(range(1001, 1011))
    tx = A.accessible_records(fixture.records["Transaction"], fixture.access, "FINANCE_ANALYST", A.TRANSACTION_LIST)
    assert tx.count() == 10 and "transaction_amount" not in tx.columns
    assert A.denied_sample(fixture.records, KEYS, fixture.access, "PUBLIC_USER").count() == 0
    assert A.denied_sample(fixture.records, KEYS, fixture.access, "DATA_ANALYST", 3).count() == 3
    assert A.denied_sample(fixture.records, KEYS, fixture.access, "DATA_ANALYST").count() == 10
    assert A.hr_employees(fixture.records["Employee"], fixture.access).count() == 0


def test_columns_of_one_table(fixture):
    hr = A.accessible_columns(fixture.catalog, fixture.access, "HR_MANAGER", "EMPLOYEES")
    assert hr.count() == 16
    lists = A.accessible_column_lists(fixture.catalog, fixture.access, "HR_MANAGER", "EMPLOYEES").collect()
    assert len(lists) == 16 and {r.accessible_column_count for r in lists} == {16}
    assert "EMAIL (PII)" in {r.accessible_column for r in lists}
    seen = A.column_visibility(fixture.catalog, fixture.access, "HR_MANAGER", "EMPLOYEES").collect()
    assert [r.column_name for r in seen][:2] == ["EMPLOYEE_ID", "EMPLOYEE_NUMBER"]
    assert sum(r.access_decision == "VISIBLE" for r in seen) == 16 and len(seen) == 21
    assert A.column_listing(fixture.catalog).count() == 81
    assert [r.ordinal_position for r in A.column_listing(fixture.catalog, "CUSTOMERS").collect()] == list(range(1, 17))


def test_column_decisions(fixture):
    found = A.column_decisions(fixture.catalog, fixture.access, "FINANCE_ANALYST", "FINANCIAL_TRANSACTIONS").collect()
    texts = [r.access_decision for r in found]
    assert texts.count("VISIBLE - Masking policy applies") == 7 and texts.count("VISIBLE - No masking") == 8
    pii = A.column_decisions(fixture.catalog, fixture.access, "HR_MANAGER", "CUSTOMERS").where(
        F.col("classification") == "PII")
    assert {r.access_decision for r in pii.collect()} == {"BLOCKED"}


def test_employee_projections(fixture):
    hr = A.hr_employees(fixture.records["Employee"], fixture.access)
    assert hr.count() == 0 and "salary" in hr.columns
    eng = A.engineer_employees(fixture.records["Employee"], fixture.access).collect()
    assert len(eng) == 10 and eng[0].salary_note == "VISIBLE (Restricted)"


def test_roles(spark, fixture):
    top = spark.createDataFrame([("DATA_GOVERNANCE_ADMIN",)], "id string")
    chains = {tuple(r.role_chain) for r in A.role_chains(inherits_df(spark), top).collect()}
    assert len(chains) == 6
    assert ("DATA_GOVERNANCE_ADMIN", "DATA_ENGINEER", "DATA_ANALYST", "HR_MANAGER") in chains
    assert [r.role for r in A.roles_for_tier(fixture.roles, fixture.access, "Restricted").collect()] == [
        "DATA_GOVERNANCE_ADMIN", "DATA_ENGINEER", "FINANCE_ANALYST"]
    tree = A.role_hierarchy(fixture.roles, inherits_df(spark)).collect()
    assert len(tree) == 10 and sum(r.parent is None for r in tree) == 4


def test_decisions(spark, fixture):
    asked = spark.createDataFrame([("DATA_ANALYST", "Restricted"), ("DATA_ENGINEER", "PII"), ("GHOST", "Public")],
                                  "role string, classification string")
    found = {r.role: r.access_decision for r in A.decide(asked, fixture.roles, fixture.access).collect()}
    assert found == {"DATA_ANALYST": "ACCESS DENIED: Role does not have permission", "DATA_ENGINEER": "ACCESS GRANTED"}
    one = A.decide_one(fixture.roles, fixture.access, "PUBLIC_USER", "Restricted", "GRANTED", "DENIED").collect()
    assert [r.access_decision for r in one] == ["DENIED"]
    assert A.decide_one(fixture.roles, fixture.access, "GHOST", "Public").count() == 0
    short = A.decide(asked, fixture.roles, fixture.access, "GRANTED", "DENIED")
    assert {r.access_decision for r in short.collect()} == {"GRANTED", "DENIED"}


def test_lineage(fixture):
    found = A.sensitive_lineage(fixture.records, fixture.access, ("Restricted", "PII")).collect()
    assert len(found) == 4 and {r.classification for r in found} == {"Restricted"}
    assert found[0].roles_with_access == ["DATA_ENGINEER", "DATA_GOVERNANCE_ADMIN", "FINANCE_ANALYST"]
    reach = A.reachable_transactions(fixture.records["Transaction"], fixture.access, "FINANCE_ANALYST", "n").collect()
    assert [tuple(r) for r in reach] == [("FINANCE_ANALYST", 10, "Restricted", "n")]


def test_audits(fixture):
    assert [(r.table_name, r.pii_column_count) for r in A.pii_exposure(fixture.catalog).collect()] == [
        ("CUSTOMERS", 7)] * 7 + [("EMPLOYEES", 6)] * 6 + [("AUDIT_LOGS", 1)]
    known = fixture.spark.createDataFrame([("SECURITY_DEMO_DB.DEMO_SCHEMA.CUSTOMERS",)], "fqn string")
    assert {r.table_name for r in A.pii_exposure(fixture.catalog, known).collect()} == {"CUSTOMERS"}
    gaps = A.encryption_gaps(fixture.catalog)
    assert dict(rows(gaps.groupBy("table_name").count())) == {
        "CUSTOMERS": 5, "FINANCIAL_TRANSACTIONS": 6, "EMPLOYEES": 8, "PRODUCTS": 2, "AUDIT_LOGS": 4}
    assert A.encryption_gaps(fixture.raw_catalog, null_is_gap=True).count() == 25
    assert A.encryption_gaps(fixture.raw_catalog).count() == 0
    owned = A.owners(fixture.catalog).collect()
    assert len({r.owner_team for r in owned}) == 6 and len(owned) == 9
    with_empty = A.owners(fixture.catalog, exclude_empty=False).collect()
    assert len({r.owner_team for r in with_empty}) == 7 and with_empty[0].column_count == 72


def test_owner_rows_carry_their_count(fixture):
    rows_of = {}
    for r in A.owners(fixture.catalog, False).collect():
        rows_of.setdefault((r.owner_team, r.column_count), set()).add(r.owned_column)
    assert all(len(v) == n for (_, n), v in rows_of.items()) and sum(map(len, rows_of.values())) == 81


def test_customer_audit(fixture):
    found = A.customer_access_audit(fixture.records["Customer"], fixture.records["Transaction"], fixture.access,
                                    "FINANCE_ANALYST", 1001).collect()
    assert sorted(r.transaction_id for r in found) == ["txn-uuid-0001", "txn-uuid-0004"]
    denied = A.customer_access_audit(fixture.records["Customer"], fixture.records["Transaction"], fixture.access,
                                     "DATA_ANALYST", 1001)
    assert denied.count() == 0


def test_subgraphs_and_paths(fixture):
    two = {k: fixture.records[k] for k in ("Customer", "Employee")}
    assert A.visible_subgraph(two, KEYS, fixture.access).count() == 60
    assert A.visible_subgraph(two, KEYS, fixture.access, 30).count() == 30
    assert A.column_tier_pairs(fixture.catalog).count() == 81
    assert P.catalog_paths(fixture.catalog, "D", "S").count() == 81
    assert {r.table_name: r.column_count for r in A.table_column_counts(fixture.catalog).collect()} == {
        "CUSTOMERS": 16, "EMPLOYEES": 21, "FINANCIAL_TRANSACTIONS": 15, "PRODUCTS": 15, "AUDIT_LOGS": 14}
    paths = {r.start: r.path for r in A.management_paths(fixture.entities["EMPLOYEES"]).collect()}
    assert len(paths) == 10
    assert paths[5006] == [5006, 5001, 5010] and paths[5008] == [5008, 5002] and paths[5010] == [5010]
    assert A.customer_transactions(fixture.entities["FINANCIAL_TRANSACTIONS"], fixture.entities["CUSTOMERS"]).count() == 10


def test_tiers_and_policies(fixture):
    assert rows(A.tier_counts(fixture.catalog)) == [("Public", 4, 10), ("Internal", 3, 39), ("PII", 2, 14),
                                                    ("Restricted", 1, 18)]
    assert A.tier_columns(fixture.catalog).count() == 18
    listing = A.policy_listing(fixture.policies)
    assert listing.count() == 9 and listing.where("database IS NULL AND schema IS NULL").count() == 9
    assert A.policy_columns(fixture.policy_refs, fixture.catalog, fixture.policies).count() == 12
    assert A.role_tier_columns(fixture.catalog, fixture.access, "Restricted").count() == 54
    assert A.role_tier_columns(fixture.catalog, fixture.access, "Restricted", 40).count() == 40
    assert A.policy_lineage(fixture.catalog, fixture.policy_refs, fixture.access, "FINANCE_ANALYST").count() == 8
    picture = A.security_picture(fixture.catalog, fixture.policy_refs, fixture.access)
    assert picture.count() == 400
    per_role = dict(rows(picture.groupBy("role").count()))
    assert [per_role[r] for r in ROLE_NAMES] == [81, 81, 67, 63, 49, 49, 10]


def test_encryption_columns(fixture):
    three = ["CUSTOMERS", "EMPLOYEES", "FINANCIAL_TRANSACTIONS"]
    literal = A.encryption_columns(fixture.refs, three).collect()
    assert len(literal) == 7 and all(r.classification is None and r.data_owner is None for r in literal)
    whole = A.encryption_columns(fixture.refs, literal=False).collect()
    assert len(whole) == 7 and all(r.classification is not None for r in whole)
    assert A.tag_listing(fixture.refs).count() == 108
    assert A.tag_listing(fixture.refs, "CUSTOMERS").count() == 23


def test_tiers_held_by_no_role(spark, fixture):
    nobody = local_df(spark, [], "role string, classification string")
    assert A.visible_by_role(fixture.records, nobody).count() == 0
