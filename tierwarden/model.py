"""Data model: fixed governance values, keys and table schemas.

The constants below are the vocabulary every operator is defined against
(tiers, roles, grants, policies, tags).  They are small, closed lists; the
``*_df`` helpers turn them into DataFrames backed by a local relation, so Spark
knows their exact size and picks a broadcast join for them without a hint.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

DATABASE = "SECURITY_DEMO_DB"
SCHEMA = "DEMO_SCHEMA"

# --------------------------------------------------------------------------
# tags
# --------------------------------------------------------------------------
CLASSIFICATION = "data_classification"
TAG_FIELDS = (
    "data_classification",
    "data_category",
    "encryption_required",
    "retention_policy",
    "data_owner",
)
TAXONOMY = {
    "data_classification": ["PII", "Restricted", "Internal", "Public"],
    "data_category": ["Personal", "Financial", "Operational", "Marketing", "System"],
    "encryption_required": ["Yes", "No"],
    "retention_policy": ["30_days", "1_year", "7_years", "Indefinite"],
    "data_owner": None,  # open
}
UNCLASSIFIED = "Unclassified"
TAG_DEFAULTS = {
    "data_classification": UNCLASSIFIED,
    "data_category": "",
    "encryption_required": "No",
    "retention_policy": "",
    "data_owner": "",
}

# --------------------------------------------------------------------------
# Tiers (rank 1 = most sensitive)
# --------------------------------------------------------------------------
RANKS = {"Restricted": 1, "PII": 2, "Internal": 3, "Public": 4}
TIERS = [
    # name, description, color, sensitivity_rank, requires_encryption
    ("Restricted", "Highest sensitivity — financial/legal/credential data", "#DC2626", 1, True),
    ("PII", "Personally Identifiable Information — GDPR/CCPA regulated", "#EA580C", 2, True),
    ("Internal", "Internal business data — employees only", "#D97706", 3, False),
    ("Public", "Publicly available information — no restrictions", "#16A34A", 4, False),
]

# --------------------------------------------------------------------------
# Roles, their tiers and their hierarchy
# --------------------------------------------------------------------------
ROLES = [
    # name, description, hierarchy_level, can_manage_policies
    ("DATA_GOVERNANCE_ADMIN", "Full governance access", 1, True),
    ("DATA_ENGINEER", "Full read access to all data", 2, False),
    ("FINANCE_ANALYST", "Restricted financial data access", 3, False),
    ("HR_MANAGER", "Employee PII access", 3, False),
    ("SECURITY_AUDITOR", "Audit log and metadata access", 3, False),
    ("DATA_ANALYST", "Internal and Public data only", 4, False),
    ("PUBLIC_USER", "Public data access only", 5, False),
]
ROLE_NAMES = [r[0] for r in ROLES]
ROLE_TIERS = {
    "DATA_GOVERNANCE_ADMIN": ["Public", "Internal", "PII", "Restricted"],
    "DATA_ENGINEER": ["Public", "Internal", "PII", "Restricted"],
    "FINANCE_ANALYST": ["Public", "Internal", "Restricted"],
    "HR_MANAGER": ["Public", "Internal", "PII"],
    "SECURITY_AUDITOR": ["Public", "Internal"],
    "DATA_ANALYST": ["Public", "Internal"],
    "PUBLIC_USER": ["Public"],
}
INHERITS = [
    # parent, child
    ("DATA_GOVERNANCE_ADMIN", "DATA_ENGINEER"),
    ("DATA_ENGINEER", "DATA_ANALYST"),
    ("DATA_ANALYST", "HR_MANAGER"),
    ("DATA_ANALYST", "FINANCE_ANALYST"),
    ("DATA_ANALYST", "SECURITY_AUDITOR"),
    ("DATA_ANALYST", "PUBLIC_USER"),
]
STEWARDS = ("DATA_ENGINEER", "DATA_GOVERNANCE_ADMIN", "ACCOUNTADMIN")

# --------------------------------------------------------------------------
# Policies and where they are bound
# --------------------------------------------------------------------------
POLICIES = [
    # name, type, applies_to, description
    ("SSN_MASKING_POLICY", "MASKING", "Restricted",
     "Masks SSN — full for DATA_ENGINEER, last-4 for HR, blocked otherwise"),
    ("EMAIL_MASKING_POLICY", "MASKING", "PII",
     "Masks email — full for HR/Engineer, domain-only for Analyst"),
    ("AMOUNT_MASKING_POLICY", "MASKING", "Restricted",
     "Rounds financial amounts for Analysts, exact for Finance"),
    ("ACCOUNT_MASKING_POLICY", "MASKING", "Restricted",
     "Shows only last-4 of account numbers for Finance role"),
    ("IP_MASKING_POLICY", "MASKING", "Restricted",
     "IP address visible only to Security Auditors and Engineers"),
    ("SALARY_MASKING_POLICY", "MASKING", "Restricted",
     "Salary visible only to HR and Finance"),
    ("CUSTOMER_ROW_POLICY", "ROW_ACCESS", "Internal",
     "Analysts see only active customers; privileged see all"),
    ("EMPLOYEE_ROW_POLICY", "ROW_ACCESS", "Internal",
     "Active employees for Analysts; HR sees all including terminated"),
    ("TRANSACTION_FRAUD_POLICY", "ROW_ACCESS", "Restricted",
     "Fraud-flagged transactions visible only to Finance/Security/Engineer"),
]
MASK_BINDINGS = {
    # table -> column -> masking policy
    "CUSTOMERS": {"SSN": "SSN_MASKING_POLICY", "EMAIL": "EMAIL_MASKING_POLICY"},
    "EMPLOYEES": {
        "SSN": "SSN_MASKING_POLICY",
        "EMAIL": "EMAIL_MASKING_POLICY",
        "PERSONAL_EMAIL": "EMAIL_MASKING_POLICY",
        "SALARY": "SALARY_MASKING_POLICY",
        "BONUS": "SALARY_MASKING_POLICY",
    },
    "FINANCIAL_TRANSACTIONS": {
        "ACCOUNT_NUMBER": "ACCOUNT_MASKING_POLICY",
        "TRANSACTION_AMOUNT": "AMOUNT_MASKING_POLICY",
        "IP_ADDRESS": "IP_MASKING_POLICY",
    },
    "AUDIT_LOGS": {"SOURCE_IP": "IP_MASKING_POLICY", "USER_EMAIL": "EMAIL_MASKING_POLICY"},
}
ROW_BINDINGS = {
    # table -> (column, row policy)
    "CUSTOMERS": ("IS_ACTIVE", "CUSTOMER_ROW_POLICY"),
    "EMPLOYEES": ("TERMINATION_DATE", "EMPLOYEE_ROW_POLICY"),
    "FINANCIAL_TRANSACTIONS": ("FRAUD_FLAG", "TRANSACTION_FRAUD_POLICY"),
}

# --------------------------------------------------------------------------
# The five governed tables, their columns by tier, other tags
# --------------------------------------------------------------------------
TIER_SHEET = {
    "CUSTOMERS": {
        "Restricted": ("SSN",),
        "PII": ("FIRST_NAME", "LAST_NAME", "EMAIL", "PHONE", "DATE_OF_BIRTH", "ADDRESS_LINE1", "ADDRESS_LINE2"),
        "Internal": ("CUSTOMER_ID", "CITY", "STATE", "ZIP_CODE", "CUSTOMER_TIER", "CREATED_AT", "IS_ACTIVE"),
        "Public": ("COUNTRY",),
    },
    "FINANCIAL_TRANSACTIONS": {
        "Restricted": ("ACCOUNT_NUMBER", "ROUTING_NUMBER", "CARD_LAST_FOUR", "TRANSACTION_AMOUNT", "FRAUD_FLAG",
                       "IP_ADDRESS", "DEVICE_FINGERPRINT"),
        "Internal": ("TRANSACTION_ID", "CUSTOMER_ID", "TRANSACTION_TYPE", "MERCHANT_NAME", "TRANSACTION_DATE",
                     "STATUS"),
        "Public": ("MERCHANT_CATEGORY", "CURRENCY"),
    },
    "EMPLOYEES": {
        "Restricted": ("SSN", "SALARY", "BONUS", "BANK_ACCOUNT", "CLEARANCE_LEVEL"),
        "PII": ("FIRST_NAME", "LAST_NAME", "EMAIL", "PERSONAL_EMAIL", "PHONE", "DATE_OF_BIRTH"),
        "Internal": ("EMPLOYEE_ID", "EMPLOYEE_NUMBER", "HIRE_DATE", "TERMINATION_DATE", "DEPARTMENT",
                     "JOB_TITLE", "MANAGER_ID", "PERFORMANCE_RATING", "REMOTE_WORK"),
        "Public": ("LOCATION_OFFICE",),
    },
    "PRODUCTS": {
        "Restricted": ("COST_PRICE", "PROFIT_MARGIN"),
        "Internal": ("PRODUCT_ID", "UNIT_PRICE", "STOCK_QUANTITY", "REORDER_THRESHOLD", "SUPPLIER_ID",
                     "IS_ACTIVE", "LAST_MODIFIED"),
        "Public": ("PRODUCT_SKU", "PRODUCT_NAME", "PRODUCT_DESCRIPTION", "CATEGORY", "SUBCATEGORY", "LAUNCH_DATE"),
    },
    "AUDIT_LOGS": {
        "Restricted": ("SOURCE_IP", "SESSION_ID", "USER_AGENT"),
        "PII": ("USER_EMAIL",),
        "Internal": ("LOG_ID", "EVENT_TIMESTAMP", "USER_ID", "ACTION_TYPE", "RESOURCE_ACCESSED",
                     "DATA_CLASSIFICATION", "SUCCESS_FLAG", "FAILURE_REASON", "RECORDS_ACCESSED", "QUERY_HASH"),
    },
}
EXTRA_TAGS = [
    # table, tag, value, columns
    ("CUSTOMERS", "data_category", "Personal", ("EMAIL",)),
    ("CUSTOMERS", "encryption_required", "Yes", ("EMAIL", "SSN", "DATE_OF_BIRTH")),
    ("CUSTOMERS", "retention_policy", "7_years", ("SSN",)),
    ("CUSTOMERS", "data_owner", "Customer Success Team", ("EMAIL",)),
    ("CUSTOMERS", "data_owner", "Compliance Team", ("SSN",)),
    ("FINANCIAL_TRANSACTIONS", "encryption_required", "Yes", ("ACCOUNT_NUMBER",)),
    ("FINANCIAL_TRANSACTIONS", "retention_policy", "7_years", ("ACCOUNT_NUMBER",)),
    ("FINANCIAL_TRANSACTIONS", "data_category", "Financial", ("TRANSACTION_AMOUNT",)),
    ("FINANCIAL_TRANSACTIONS", "data_owner", "Risk & Fraud Team", ("FRAUD_FLAG",)),
    ("FINANCIAL_TRANSACTIONS", "data_category", "Personal", ("IP_ADDRESS",)),
    ("EMPLOYEES", "encryption_required", "Yes", ("SSN", "SALARY", "BANK_ACCOUNT")),
    ("EMPLOYEES", "retention_policy", "7_years", ("SSN", "SALARY")),
    ("EMPLOYEES", "data_owner", "HR Team", ("SSN",)),
    ("EMPLOYEES", "data_owner", "Finance Team", ("SALARY",)),
    ("EMPLOYEES", "data_owner", "Security Team", ("CLEARANCE_LEVEL",)),
    ("PRODUCTS", "data_owner", "Finance Team", ("COST_PRICE", "PROFIT_MARGIN")),
    ("PRODUCTS", "data_category", "Financial", ("COST_PRICE", "PROFIT_MARGIN")),
    ("AUDIT_LOGS", "retention_policy", "1_year", ("SOURCE_IP", "SESSION_ID")),
    ("AUDIT_LOGS", "data_owner", "Security Team", ("SOURCE_IP",)),
]

# --------------------------------------------------------------------------
# Record entities (label, key, record tier, kept columns)
# --------------------------------------------------------------------------
LABEL_OF = {
    "CUSTOMERS": "Customer",
    "EMPLOYEES": "Employee",
    "PRODUCTS": "Product",
    "FINANCIAL_TRANSACTIONS": "Transaction",
    "AUDIT_LOGS": "AuditLog",
}
KEY_OF = {
    "CUSTOMERS": "customer_id",
    "EMPLOYEES": "employee_id",
    "PRODUCTS": "product_id",
    "FINANCIAL_TRANSACTIONS": "transaction_id",
    "AUDIT_LOGS": "log_id",
}
# An audit record is Internal although three of its columns are Restricted.
TIER_OVERRIDES = {"AUDIT_LOGS": "Internal"}
KEPT_COLUMNS = {
    "CUSTOMERS": ("customer_id", "first_name", "last_name", "email", "city", "state", "country",
                  "customer_tier", "is_active"),
    "EMPLOYEES": ("employee_id", "employee_number", "first_name", "last_name", "email", "department",
                  "job_title", "location_office", "remote_work", "is_active"),
    "PRODUCTS": ("product_id", "product_sku", "product_name", "category", "subcategory", "unit_price", "is_active"),
    "FINANCIAL_TRANSACTIONS": ("transaction_id", "customer_id", "transaction_type", "merchant_name",
                               "merchant_category", "currency", "status", "fraud_flag"),
    "AUDIT_LOGS": ("log_id", "user_id", "action_type", "resource_accessed", "data_classification_accessed",
                   "success_flag", "failure_reason"),
}
# Values of kept columns that a source does not have at all.
ABSENT_DEFAULTS = {"is_active": True, "success_flag": True, "remote_work": False, "fraud_flag": False,
                   "country": "USA", "currency": "USD"}
UNIQUE_KEYS = {
    "Database": "fqn", "Schema": "fqn", "Table": "fqn", "Column": "fqn",
    "Classification": "name", "Role": "name", "Policy": "name",
    "Customer": "customer_id", "Employee": "employee_id", "Product": "product_id",
    "Transaction": "transaction_id", "AuditLog": "log_id",
}
REQUIRED = {
    "CUSTOMERS": ("customer_id", "first_name", "last_name", "email"),
    "FINANCIAL_TRANSACTIONS": ("transaction_id", "customer_id", "account_number", "transaction_amount"),
    "EMPLOYEES": ("employee_id", "employee_number", "first_name", "last_name", "email"),
    "PRODUCTS": ("product_id", "product_sku", "product_name"),
    "AUDIT_LOGS": ("log_id", "event_timestamp"),
}
NOW = object()  # placeholder for "time of the run" in INSERT_DEFAULTS
INSERT_DEFAULTS = {
    "CUSTOMERS": {"country": "USA", "created_at": NOW, "is_active": True},
    "FINANCIAL_TRANSACTIONS": {"currency": "USD", "fraud_flag": False},
    "EMPLOYEES": {"remote_work": False},
    "PRODUCTS": {"is_active": True},
    "AUDIT_LOGS": {},
}

# --------------------------------------------------------------------------
# Schemas of state tables and of the generic graph form
# --------------------------------------------------------------------------
_S = T.StringType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, _S) for n in names]


TAG_REF_SCHEMA = T.StructType(_strings(
    "tag_database", "tag_schema", "tag_name", "tag_value",
    "object_database", "object_schema", "object_name", "column_name", "domain"))
CATALOG_SCHEMA = T.StructType(
    _strings("table_name", "column_name", "data_type", "is_nullable")
    + [T.StructField("ordinal_position", T.IntegerType())] + _strings(*TAG_FIELDS))
POLICY_REF_SCHEMA = T.StructType(_strings(
    "table_name", "column_name", "policy_name", "policy_kind", "policy_status"))
TAG_SNAPSHOT_SCHEMA = T.StructType(
    [T.StructField("snapshot_id", T.LongType())] + _strings("table_name", "column_name", *TAG_FIELDS)
    + [T.StructField("captured_at", T.TimestampType())])
CHANGE_LOG_SCHEMA = T.StructType(
    [T.StructField("change_id", T.LongType()), T.StructField("changed_at", T.TimestampType())]
    + _strings("table_name", "column_name", "tag_field", "old_value", "new_value", "sync_status")
    + [T.StructField("synced_at", T.TimestampType())])
SYNC_RUN_SCHEMA = T.StructType([
    T.StructField("sync_ts", T.TimestampType()), T.StructField("source_columns", T.LongType()),
    T.StructField("catalog_columns", T.LongType()), T.StructField("new", T.LongType()),
    T.StructField("changed", T.LongType()), T.StructField("unchanged", T.LongType()),
    T.StructField("written", T.LongType())])
PROPS = T.MapType(_S, _S)
VERTEX_SCHEMA = T.StructType([
    T.StructField("id", _S), T.StructField("labels", T.ArrayType(_S)), T.StructField("props", PROPS)])
EDGE_SCHEMA = T.StructType([
    T.StructField("src", _S), T.StructField("dst", _S), T.StructField("type", _S),
    T.StructField("props", PROPS)])


# --------------------------------------------------------------------------
# DataFrames over the fixed values
# --------------------------------------------------------------------------
def local_df(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """Rows as a local relation (exact size known to the planner)."""
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [[] for _ in target.fields]
    arrays = [pa.array(list(c), type=to_arrow_type(f.dataType)) for c, f in zip(columns, target.fields)]
    return spark.createDataFrame(pa.table(dict(zip(target.names, arrays))), schema=target)


def tiers_df(spark: SparkSession) -> DataFrame:
    who = {t: [r for r in ROLE_NAMES if t in ROLE_TIERS[r]] for t in RANKS}
    return local_df(
        spark, [(*t, who[t[0]]) for t in TIERS],
        "name string, description string, color string, sensitivity_rank int, "
        "requires_encryption boolean, access_roles array<string>")


def roles_df(spark: SparkSession) -> DataFrame:
    return local_df(spark, ROLES, "name string, description string, hierarchy_level int, "
                                  "can_manage_policies boolean")


def can_access_df(spark: SparkSession) -> DataFrame:
    pairs = [(role, tier) for role, allowed in ROLE_TIERS.items() for tier in allowed]
    return local_df(spark, pairs, "role string, classification string")


def inherits_df(spark: SparkSession) -> DataFrame:
    return local_df(spark, INHERITS, "parent string, child string")


def policies_df(spark: SparkSession) -> DataFrame:
    return local_df(spark, POLICIES, "name string, type string, applies_to string, description string")


def taxonomy_df(spark: SparkSession) -> DataFrame:
    return local_df(spark, list(TAXONOMY.items()), "tag_name string, allowed_values array<string>")


def policy_refs_df(spark: SparkSession, tables: list[str] | None = None) -> DataFrame:
    """Column masks and row rules as reference rows; empty (with schema) for unknown tables."""
    rows = [(t, c, p, "MASKING_POLICY", "ACTIVE") for t, cols in MASK_BINDINGS.items()
            for c, p in cols.items()]
    rows += [(t, c, p, "ROW_ACCESS_POLICY", "ACTIVE") for t, (c, p) in ROW_BINDINGS.items()]
    if tables is not None:
        wanted = {t.upper() for t in tables}
        rows = [r for r in rows if r[0] in wanted]
    return local_df(spark, rows, POLICY_REF_SCHEMA)


def grants_df(spark: SparkSession, role: str | None = None) -> DataFrame:
    """Role-to-role and usage grants, optionally those held by one role."""
    rows = [("SYSADMIN", "USAGE", "ROLE DATA_GOVERNANCE_ADMIN")]
    rows += [(parent, "USAGE", f"ROLE {child}") for parent, child in INHERITS]
    rows += [(r, "USAGE", f"DATABASE {DATABASE}") for r in ROLE_NAMES]
    rows += [(r, "USAGE", f"SCHEMA {DATABASE}.{SCHEMA}") for r in ROLE_NAMES]
    if role is not None:
        rows = [r for r in rows if r[0] == role]
    return local_df(spark, rows, "role string, privilege string, object string")


def sheet_assignments() -> list[tuple[str, str, str, str]]:
    """(table, column, tag, value) for the five governed tables."""
    out = [(table, column, CLASSIFICATION, tier)
           for table, by_tier in TIER_SHEET.items()
           for tier, names in by_tier.items() for column in names]
    out += [(table, column, tag, value)
            for table, tag, value, names in EXTRA_TAGS for column in names]
    return out


def sheet_tag_refs(spark: SparkSession) -> DataFrame:
    rows = [(DATABASE, SCHEMA, tag.upper(), value, DATABASE, SCHEMA, table, column, "COLUMN")
            for table, column, tag, value in sheet_assignments()]
    return local_df(spark, rows, TAG_REF_SCHEMA)
