"""The same questions in plain SQL over the given tables, for checking results."""

from __future__ import annotations

from tierwarden.model import POLICIES, ROLES, TAXONOMY

# Fixed values, written out here so that a wrong constant of the library does not pass both sides.
DATABASE, SCHEMA = "SECURITY_DEMO_DB", "DEMO_SCHEMA"
RANKS = {"Restricted": 1, "PII": 2, "Internal": 3, "Public": 4}
TAG_FIELDS = ("data_classification", "data_category", "encryption_required", "retention_policy", "data_owner")
ROLE_NAMES = ["DATA_GOVERNANCE_ADMIN", "DATA_ENGINEER", "FINANCE_ANALYST", "HR_MANAGER", "SECURITY_AUDITOR",
              "DATA_ANALYST", "PUBLIC_USER"]
ROLE_TIERS = {
    "DATA_GOVERNANCE_ADMIN": ["Public", "Internal", "PII", "Restricted"],
    "DATA_ENGINEER": ["Public", "Internal", "PII", "Restricted"],
    "FINANCE_ANALYST": ["Public", "Internal", "Restricted"],
    "HR_MANAGER": ["Public", "Internal", "PII"],
    "SECURITY_AUDITOR": ["Public", "Internal"],
    "DATA_ANALYST": ["Public", "Internal"],
    "PUBLIC_USER": ["Public"],
}
INHERITS = [("DATA_GOVERNANCE_ADMIN", "DATA_ENGINEER"),
            ("DATA_ENGINEER", "DATA_ANALYST"),
            ("DATA_ANALYST", "HR_MANAGER"),
            ("DATA_ANALYST", "FINANCE_ANALYST"),
            ("DATA_ANALYST", "SECURITY_AUDITOR"),
            ("DATA_ANALYST", "PUBLIC_USER")]
MASKS = ["ACCOUNT_MASKING_POLICY", "AMOUNT_MASKING_POLICY", "EMAIL_MASKING_POLICY", "IP_MASKING_POLICY",
         "SALARY_MASKING_POLICY", "SSN_MASKING_POLICY"]
FIELD_LISTS = {
    ("CUSTOMERS", "Restricted"): "ssn",
    ("CUSTOMERS", "PII"): "address_line1,address_line2,date_of_birth,email,first_name,last_name,phone",
    ("EMPLOYEES", "Restricted"): "bank_account,bonus,clearance_level,salary,ssn",
    ("EMPLOYEES", "PII"): "date_of_birth,email,first_name,last_name,personal_email,phone",
    ("PRODUCTS", "Public"): "category,launch_date,product_description,product_name,product_sku,subcategory",
    ("PRODUCTS", "Restricted"): "cost_price,profit_margin",
    ("FINANCIAL_TRANSACTIONS", "Restricted"): "account_number,card_last_four,device_fingerprint,fraud_flag,ip_address,"
                                              "routing_number,transaction_amount",
}

PRIV = "'DATA_ENGINEER','DATA_GOVERNANCE_ADMIN','ACCOUNTADMIN'"
READERS = ROLE_NAMES + ["ACCOUNTADMIN", "GUEST"]
FQN = f"'{DATABASE}.{SCHEMA}.'"


def _values(name: str, columns: str, rows: list[tuple]) -> str:
    def lit(v):
        return ("true" if v else "false") if isinstance(v, bool) else str(v) if isinstance(v, int) \
            else "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def _pad(x: str, n: int) -> str:
    return f"lpad(CAST({x} AS VARCHAR),{n},'0')"


def _case(index: str, values: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {index}={i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def _ssn(k: str) -> str:
    p = _pad(k, 9)
    return f"CASE WHEN {k}%11<>10 THEN substr({p},1,3)||'-'||substr({p},4,2)||'-'||substr({p},6,4) END"


PART_TABLE = f"'T'||{_pad('p_partkey//16', 10)}"
PART_COLUMN = f"'C'||{_pad('p_partkey%16', 2)}"
LINE_TABLE = f"'T'||{_pad('l_partkey//16', 10)}"
LINE_COLUMN = f"'C'||{_pad('l_partkey%16', 2)}"
QTY = "CAST(floor(l_quantity) AS INT)"
RULES = ["CUSTOMER_ROW_POLICY", "EMPLOYEE_ROW_POLICY", "TRANSACTION_FRAUD_POLICY"]

CTE: dict[str, str] = {}
CTE["places"] = ("places AS (SELECT n_nationkey, n_name, r_name FROM nation "
                 "JOIN region ON n_regionkey=r_regionkey)")
CTE["customers"] = f"""customers AS (SELECT c_custkey AS customer_id,
  split_part(c_name,'#',1) AS first_name, split_part(c_name,'#',2) AS last_name,
  lower(replace(c_name,'#','.'))||'@'||lower(c_mktsegment)||'.example' AS email,
  {_ssn('c_custkey')} AS ssn,
  CASE WHEN c_custkey%3=0 THEN 'Unit '||(c_custkey%100) END AS address_line2,
  n_name AS city, 'S'||n_nationkey AS state, r_name AS country, c_mktsegment AS customer_tier,
  CAST(DATE '2015-01-01' + CAST(c_custkey%3000 AS INT) AS TIMESTAMP) AS created_at,
  c_acctbal>=0 AS is_active
  FROM customer LEFT JOIN places ON c_nationkey=n_nationkey)"""
CTE["transactions"] = f"""transactions AS (SELECT 'txn-'||{_pad('o_orderkey', 12)} AS transaction_id,
  o_custkey AS customer_id, 'ACC-'||{_pad('o_custkey', 9)} AS account_number,
  CAST(o_totalprice AS DECIMAL(12,2)) AS transaction_amount,
  CASE o_orderstatus WHEN 'F' THEN 'Purchase' WHEN 'O' THEN 'Transfer' ELSE 'Subscription' END AS transaction_type,
  'Merchant '||(o_custkey%100) AS merchant_name, o_orderpriority AS merchant_category, 'USD' AS currency,
  CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' ELSE 'Declined' END AS status,
  (o_orderpriority='1-URGENT' AND o_orderstatus='P') AS fraud_flag,
  '10.0.'||((o_custkey//256)%256)||'.'||(o_custkey%256) AS ip_address
  FROM orders)"""
CTE["employees"] = f"""employees AS (SELECT s_suppkey AS employee_id, 'EMP-'||{_pad('s_suppkey', 9)} AS employee_number,
  split_part(s_name,'#',1) AS first_name, split_part(s_name,'#',2) AS last_name,
  lower(replace(s_name,'#','.'))||'@company.example' AS email,
  CASE WHEN s_suppkey%6<>5 THEN 'home'||s_suppkey||'@mail.example' END AS personal_email,
  {_ssn('s_suppkey')} AS ssn,
  CASE WHEN s_suppkey%10=7 THEN DATE '2024-06-30' END AS termination_date,
  n_name AS department, 'Grade '||(s_suppkey%5) AS job_title,
  CASE WHEN s_suppkey%25=24 THEN -1 WHEN s_suppkey<>0 THEN (s_suppkey-1)//4 END AS manager_id,
  CAST(abs(s_acctbal) AS DECIMAL(12,2)) AS salary,
  CAST(round(CAST(abs(s_acctbal) AS DECIMAL(12,2))*CAST(0.1 AS DECIMAL(3,1)),2) AS DECIMAL(12,2)) AS bonus,
  r_name AS location_office, s_suppkey%4=0 AS remote_work
  FROM supplier LEFT JOIN places ON s_nationkey=n_nationkey)"""
CTE["products"] = f"""products AS (SELECT p_partkey AS product_id, 'SKU-'||{_pad('p_partkey', 9)} AS product_sku,
  p_name AS product_name, p_type AS category, p_brand AS subcategory,
  CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, p_size%10<>0 AS is_active FROM part)"""
CTE["audit_logs"] = f"""audit_logs AS (SELECT 'log-'||{_pad('event_id', 12)} AS log_id, 'user:'||user_id AS user_id,
  CASE WHEN user_id%10<>0 THEN 'user'||user_id||'@company.example' END AS user_email,
  '10.1.'||((user_id//256)%256)||'.'||(user_id%256) AS source_ip, event_type AS action_type,
  'table_'||(event_id%50)||'.*' AS resource_accessed,
  {_case('event_id%4', list(RANKS))} AS data_classification,
  event_type<>'error' AS success_flag,
  CASE WHEN event_type='error' THEN 'Insufficient permissions' END AS failure_reason,
  event_id%1000 AS records_accessed
  FROM events)"""

_CLASS = ["Restricted", "Restricted", "PII", "PII", "Internal", " Internal ", "Internal", "Public", "", "Secret"]
_TEAMS = ["Compliance Team", "Finance Team", "HR Team", "Security Team", "Risk & Fraud Team", ""]
CTE["history"] = f"""history AS (SELECT {LINE_TABLE} AS table_name, {LINE_COLUMN} AS column_name,
  CASE WHEN l_linenumber<=3 THEN 'data_classification' WHEN l_linenumber=4 THEN 'data_category'
       WHEN l_linenumber=5 THEN 'encryption_required' WHEN l_linenumber=6 THEN 'retention_policy'
       ELSE 'data_owner' END AS tag_name,
  CASE WHEN l_linenumber<=3 THEN {_case(QTY + '%10', _CLASS)}
       WHEN l_linenumber=4 THEN {_case(QTY + '%4', ['Personal', 'Financial', 'Operational', ''])}
       WHEN l_linenumber=5 THEN {_case(QTY + '%3', ['Yes', 'No', ''])}
       WHEN l_linenumber=6 THEN {_case(QTY + '%5', ['30_days', '1_year', '7_years', 'Indefinite', ''])}
       ELSE {_case(QTY + '%7', _TEAMS)} END AS tag_value,
  l_shipdate AS assigned_at, l_orderkey AS statement_id, l_linenumber AS line FROM lineitem)"""


def _assigned(name: str, where: str = "") -> str:
    return f"""{name} AS (SELECT table_name, column_name, tag_name, tag_value FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, column_name, tag_name
    ORDER BY assigned_at DESC, statement_id DESC, line DESC, tag_value DESC NULLS LAST) AS rn
  FROM history {where}) WHERE rn=1)"""


def _wide(name: str, source: str) -> str:
    picks = ", ".join(f"max(CASE WHEN tag_name='{f}' THEN tag_value END) AS {f}" for f in TAG_FIELDS)
    return f"{name} AS (SELECT table_name, column_name, {picks} FROM {source} GROUP BY table_name, column_name)"


def _trim(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x},'^\s+',''),'\s+$','')"


def _filled(name: str, source: str, inventory: str) -> str:
    def fill(f: str, default: str) -> str:
        return f"coalesce(nullif({_trim(f)},''),'{default}') AS {f}"
    return f"""{name} AS (SELECT table_name, column_name, {fill('data_type', 'UNKNOWN')}, {fill('is_nullable', 'YES')},
  ordinal_position, {fill('data_classification', 'Unclassified')}, {fill('data_category', '')},
  {fill('encryption_required', 'No')}, {fill('retention_policy', '')}, {fill('data_owner', '')}
  FROM {inventory} JOIN {source} USING (table_name, column_name))"""


CTE["assigned"] = _assigned("assigned")
CTE["old_assigned"] = _assigned("old_assigned", "WHERE assigned_at < TIMESTAMP '2000-01-01'")
CTE["tags"] = _wide("tags", "assigned")
CTE["old_tags"] = _wide("old_tags", "old_assigned")
CTE["inventory"] = f"""inventory AS (SELECT {PART_TABLE} AS table_name, {PART_COLUMN} AS column_name,
  CASE p_type WHEN 'ECONOMY' THEN 'TEXT' WHEN 'SMALL' THEN 'NUMBER' WHEN 'MEDIUM' THEN 'DATE'
    WHEN 'PROMO' THEN 'BOOLEAN' WHEN 'STANDARD' THEN 'TIMESTAMP_NTZ' ELSE '' END AS data_type,
  CASE WHEN p_size%2=0 THEN 'NO' WHEN p_size%5<>0 THEN 'YES' END AS is_nullable,
  CAST(p_partkey%16+1 AS INT) AS ordinal_position, p_size FROM part)"""
CTE["live"] = "live AS (SELECT * FROM inventory WHERE p_size<50)"
CTE["catalog"] = _filled("catalog", "tags", "inventory")
CTE["stored"] = _filled("stored", "old_tags", "inventory")
CTE["incoming"] = """incoming AS (SELECT table_name, column_name, data_type, is_nullable, ordinal_position,
  data_classification, data_category, encryption_required, retention_policy, data_owner
  FROM live JOIN tags USING (table_name, column_name))"""
CTE["incoming_filled"] = _filled("incoming_filled", "tags", "live")
CTE["policy_refs"] = f"""policy_refs AS (SELECT {PART_TABLE} AS table_name, {PART_COLUMN} AS column_name,
  CASE WHEN p_size<=24 THEN {_case('p_size%6', MASKS)} ELSE {_case('p_size-25', RULES)} END AS policy_name,
  CASE WHEN p_size<=24 THEN 'MASKING_POLICY' ELSE 'ROW_ACCESS_POLICY' END AS policy_kind,
  CASE WHEN p_size%8=0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS policy_status FROM part WHERE p_size<=27)"""
CTE["access"] = _values("access", "role, classification", [(r, t) for r, ts in ROLE_TIERS.items() for t in ts])
CTE["base_roles"] = _values("base_roles", "base, description, level, can_manage", ROLES)
CTE["ranks"] = _values("ranks", "classification, sensitivity_rank", list(RANKS.items()))
CTE["policies"] = _values("policies", "name, type, applies_to, description", POLICIES)
CTE["taxonomy"] = _values("taxonomy", "tag_name, tag_value",
                          [(t, v) for t, vs in TAXONOMY.items() if vs for v in vs])
CTE["teams"] = f"""teams AS (SELECT 'TEAM_'||{_pad('s_suppkey', 10)} AS name, base, description, level
  FROM supplier JOIN base_roles ON base={_case('s_suppkey%7', ROLE_NAMES)})"""
CTE["team_access"] = "team_access AS (SELECT name AS role, classification FROM teams JOIN access ON base=role)"
CTE["team_tree"] = f"""team_tree AS (SELECT 'TEAM_'||{_pad('(s_suppkey-1)//4', 10)} AS parent,
  'TEAM_'||{_pad('s_suppkey', 10)} AS child FROM supplier WHERE s_suppkey>0)"""
CTE["requests"] = f"""requests AS (SELECT event_id AS request_id,
  {_case('user_id%8', ROLE_NAMES + ['GUEST'])} AS role, {_case('event_id%4', list(RANKS))} AS classification
  FROM events)"""
CTE["counts"] = """counts AS (
  SELECT 'Customer' AS node_type, 'Restricted' AS classification, count(*) AS n FROM customer
  UNION ALL SELECT 'Employee','Restricted',count(*) FROM supplier
  UNION ALL SELECT 'Product','Restricted',count(*) FROM part
  UNION ALL SELECT 'Transaction','Restricted',count(*) FROM orders
  UNION ALL SELECT 'AuditLog','Internal',count(*) FROM events)"""
CTE["row_counts"] = """row_counts AS (
  SELECT 'Customer' AS node_type, CASE WHEN ssn IS NOT NULL THEN 'Restricted' ELSE 'PII' END AS classification,
    count(*) AS n FROM customers GROUP BY ALL
  UNION ALL SELECT 'Employee','Restricted',count(*) FROM supplier
  UNION ALL SELECT 'Product','Restricted',count(*) FROM part
  UNION ALL SELECT 'Transaction','Restricted',count(*) FROM orders
  UNION ALL SELECT 'AuditLog','Restricted',count(*) FROM events)"""
NEEDS = {
    "customers": ["places"], "employees": ["places"], "assigned": ["history"], "old_assigned": ["history"],
    "tags": ["assigned"], "old_tags": ["old_assigned"], "live": ["inventory"],
    "catalog": ["inventory", "tags"], "stored": ["inventory", "old_tags"], "incoming": ["live", "tags"],
    "incoming_filled": ["live", "tags"], "teams": ["base_roles"], "team_access": ["teams", "access"],
    "row_counts": ["customers"],
}


def _with(body: str, *names: str) -> str:
    ordered: list[str] = []

    def add(n: str) -> None:
        for need in NEEDS.get(n, []):
            add(need)
        if n not in ordered:
            ordered.append(n)
    for n in names:
        add(n)
    return "WITH " + ",\n".join(CTE[n] for n in ordered) + "\n" + body


# Masks and row rules as SQL over a role expression.
def _mask(policy: str, col: str, role: str) -> str:
    return {
        "ssn": f"CASE WHEN {role} IN ({PRIV}) THEN {col} WHEN {role} IN ('HR_MANAGER','FINANCE_ANALYST') "
               f"THEN '***-**-'||right({col},4) ELSE '***-**-****' END",
        "email": f"CASE WHEN {role} IN ({PRIV},'HR_MANAGER') THEN {col} WHEN {role} IN "
                 f"('DATA_ANALYST','SECURITY_AUDITOR') THEN '***@'||split_part({col},'@',2) ELSE '***@***.***' END",
        "amount": f"CAST(CASE WHEN {role} IN ({PRIV},'FINANCE_ANALYST') THEN {col} WHEN {role}='DATA_ANALYST' "
                  f"THEN round({col},-2) ELSE -1 END AS DECIMAL(12,2))",
        "account": f"CASE WHEN {role} IN ({PRIV}) THEN {col} WHEN {role}='FINANCE_ANALYST' "
                   f"THEN '****-****-****-'||right({col},4) ELSE '****-****-****-****' END",
        "ip": f"CASE WHEN {role} IN ({PRIV},'SECURITY_AUDITOR') THEN {col} ELSE '***.***.***.***' END",
        "salary": f"CAST(CASE WHEN {role} IN ({PRIV},'FINANCE_ANALYST','HR_MANAGER') THEN {col} ELSE -1 END "
                  "AS DECIMAL(12,2))",
    }[policy]


def _rows(table: str, role: str) -> str:
    return {
        "CUSTOMERS": f"CASE WHEN {role} IN ({PRIV},'HR_MANAGER','FINANCE_ANALYST') THEN true "
                     f"WHEN {role} IN ('DATA_ANALYST','SECURITY_AUDITOR') THEN is_active ELSE false END",
        "EMPLOYEES": f"CASE WHEN {role} IN ({PRIV},'HR_MANAGER') THEN true "
                     f"WHEN {role} IN ('DATA_ANALYST','FINANCE_ANALYST') THEN termination_date IS NULL ELSE false END",
        "FINANCIAL_TRANSACTIONS": f"CASE WHEN {role} IN ({PRIV},'FINANCE_ANALYST','SECURITY_AUDITOR') THEN true "
                                  "ELSE NOT fraud_flag END",
        "AUDIT_LOGS": "true",
    }[table]


def _secured(table: str, role: str) -> str:
    r = f"'{role}'"
    body, source = {
        "CUSTOMERS": (f"customer_id, {_mask('email', 'email', r)} AS email, {_mask('ssn', 'ssn', r)} AS ssn, city, "
                      "is_active", "customers"),
        "EMPLOYEES": (f"employee_id, first_name, last_name, {_mask('email', 'email', r)} AS email, "
                      f"{_mask('email', 'personal_email', r)} AS personal_email, {_mask('ssn', 'ssn', r)} AS ssn, "
                      f"{_mask('salary', 'salary', r)} AS salary, {_mask('salary', 'bonus', r)} AS bonus", "employees"),
        "FINANCIAL_TRANSACTIONS": (
            f"transaction_id, customer_id, {_mask('account', 'account_number', r)} AS account_number, "
            f"{_mask('amount', 'transaction_amount', r)} AS transaction_amount, "
            f"{_mask('ip', 'ip_address', r)} AS ip_address, fraud_flag", "transactions"),
        "AUDIT_LOGS": (f"log_id, {_mask('email', 'user_email', r)} AS user_email, "
                       f"{_mask('ip', 'source_ip', r)} AS source_ip, action_type", "audit_logs"),
    }[table]
    return _with(f"SELECT {body} FROM {source} WHERE {_rows(table, r)}", source)


def _totals(table: str, source: str, mask: str, col: str) -> str:
    parts = []
    for role in READERS:
        r = f"'{role}'"
        parts.append(f"SELECT {r} AS role, count(*) AS visible_rows, "
                     f"CAST(sum({_mask(mask, col, r)}) AS DECIMAL(22,2)) AS total FROM {source} "
                     f"WHERE {_rows(table, r)}")
    return _with(" UNION ALL ".join(parts), source)


def _fields(table: str, tier: str) -> str:
    return FIELD_LISTS[table, tier]


COLUMN_ID = f"'Column:'||{FQN}||table_name||'.'||column_name"
TABLE_ID = f"'Table:'||{FQN}||table_name"
TIER_IN = "('Restricted','PII','Internal','Public')"

SQL: dict[str, str] = {}
SQL["a01_entity_read"] = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders"
SQL["a02_tag_refs"] = _with(
    f"SELECT '{DATABASE}' AS tag_database, '{SCHEMA}' AS tag_schema, upper(tag_name) AS tag_name, tag_value, "
    f"'{DATABASE}' AS object_database, '{SCHEMA}' AS object_schema, table_name AS object_name, column_name, "
    "'COLUMN' AS domain FROM assigned", "assigned")
SQL["a04_table_inventory"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
    for t in ["customer", "events", "lineitem", "orders", "part", "supplier"])
SQL["a05_policy_refs"] = _with("SELECT * FROM policy_refs", "policy_refs")
SQL["a10_label_csv"] = _with(
    "SELECT 'Employee:'||employee_id AS id, department, email, CAST(employee_id AS VARCHAR) AS employee_id, "
    "employee_number, first_name, CAST(termination_date IS NULL AS VARCHAR) AS is_active, job_title, last_name, "
    "location_office, CAST(remote_work AS VARCHAR) AS remote_work FROM employees", "employees")

_VERTICES = [("Customer", "customer"), ("Employee", "supplier"), ("Product", "part"), ("Transaction", "orders"),
             ("AuditLog", "events"), ("Column", "catalog"), ("Table", "(SELECT DISTINCT table_name FROM catalog)")]
_FIXED = [("Database", 1), ("Schema", 1), ("AccessControlConfig", 1), ("Classification", 4), ("Role", 7),
          ("Policy", 9)]
_EDGES = [("CONTAINS_TABLE", "(SELECT DISTINCT table_name FROM catalog)"), ("HAS_COLUMN", "catalog"),
          ("CLASSIFIED_AS", f"(SELECT * FROM catalog WHERE data_classification IN {TIER_IN})"),
          ("MASKS", "(SELECT 1 FROM policy_refs JOIN catalog USING (table_name, column_name) "
                    "WHERE policy_kind='MASKING_POLICY')"),
          ("REPORTS_TO", "(SELECT 1 FROM employees e JOIN employees m ON e.manager_id=m.employee_id)"),
          ("MADE_TRANSACTION", "(SELECT 1 FROM orders JOIN customer ON o_custkey=c_custkey)"),
          ("HAS_CLASSIFICATION", "(SELECT 1 FROM customer UNION ALL SELECT 1 FROM supplier UNION ALL SELECT 1 FROM part "
                                 "UNION ALL SELECT 1 FROM orders UNION ALL SELECT 1 FROM events)")]
_FIXED_EDGES = [("CONTAINS_SCHEMA", 1), ("CAN_ACCESS", 19), ("INHERITS_FROM", 6)]
_SUMMARY = _with(
    "SELECT kind, name, n FROM (" + " UNION ALL ".join(
        [f"SELECT 'label' AS kind, '{k}' AS name, count(*) AS n FROM {t}" for k, t in _VERTICES]
        + [f"SELECT 'label', '{k}', {n}" for k, n in _FIXED]
        + [f"SELECT 'type', '{k}', count(*) FROM {t}" for k, t in _EDGES]
        + [f"SELECT 'type', '{k}', {n}" for k, n in _FIXED_EDGES]) + ")",
    "catalog", "policy_refs", "employees")
_SUMMARY = (f"WITH s AS ({_SUMMARY}) SELECT * FROM s UNION ALL SELECT 'total', 'vertices', "
            "CAST(sum(n) AS BIGINT) FROM s WHERE kind='label' UNION ALL "
            "SELECT 'total', 'edges', CAST(sum(n) AS BIGINT) FROM s WHERE kind='type'")
SQL["a12_snapshot_round_trip"] = _SUMMARY
SQL["k11_graph_summary"] = _SUMMARY
SQL["a12_snapshot_typed"] = _with("SELECT * FROM products", "products")

SQL["b01_tag_violations"] = _with(
    "SELECT table_name, column_name, a.tag_name, a.tag_value, 'VALUE NOT ALLOWED' AS violation FROM assigned a "
    "LEFT JOIN taxonomy t ON a.tag_name=t.tag_name AND a.tag_value=t.tag_value "
    "WHERE t.tag_name IS NULL AND a.tag_value IS NOT NULL AND a.tag_name<>'data_owner'", "assigned", "taxonomy")
SQL["b02_assigned_tags"] = _with("SELECT * FROM assigned", "assigned")
SQL["b03_defaults"] = _with(
    "SELECT customer_id, CASE WHEN customer_id%7<>0 THEN country ELSE 'USA' END AS country, "
    "CAST(CASE WHEN customer_id%3<>0 THEN created_at ELSE TIMESTAMP '2024-07-01' END AS VARCHAR) AS created_at, "
    "CASE WHEN customer_id%5<>0 THEN is_active ELSE true END AS is_active FROM customers", "customers")
SQL["b04_duplicate_keys"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST({k} AS VARCHAR) AS key_value, count(*) AS rows FROM {s} "
    f"GROUP BY 1, 2 HAVING count(*)>1"
    for t, k, s in [("CUSTOMERS", "c_custkey", "customer"), ("EMPLOYEES", "s_suppkey", "supplier"),
                    ("PRODUCTS", "p_partkey", "part"), ("FINANCIAL_TRANSACTIONS", "o_orderkey", "orders"),
                    ("AUDIT_LOGS", "event_id", "events"), ("ACCOUNTS", f"'ACC-'||{_pad('o_custkey', 9)}", "orders")])
SQL["b05_null_columns"] = _with(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*)-count({c}) AS null_rows FROM {s}"
        for t, s, cs in [
            ("CUSTOMERS", "customers", "customer_id email ssn address_line2"),
            ("EMPLOYEES", "employees", "employee_id manager_id termination_date"),
            ("FINANCIAL_TRANSACTIONS", "transactions", "transaction_id customer_id account_number transaction_amount"),
            ("AUDIT_LOGS", "audit_logs", "log_id user_email failure_reason")]
        for c in cs.split()) + ") WHERE null_rows>0", "customers", "employees", "transactions", "audit_logs")

_KEPT = {
    "customers": "customer_id, first_name, last_name, email, city, state, country, customer_tier, is_active",
    "employees": "employee_id, employee_number, first_name, last_name, email, department, job_title, "
                 "location_office, remote_work, termination_date IS NULL AS is_active",
    "products": "product_id, product_sku, product_name, category, subcategory, unit_price, is_active",
    "financial_transactions": "transaction_id, customer_id, transaction_type, merchant_name, merchant_category, "
                              "currency, status, fraud_flag",
    "audit_logs": "log_id, user_id, action_type, resource_accessed, "
                  "data_classification AS data_classification_accessed, success_flag, failure_reason",
}


def _source(table: str) -> str:
    return "transactions" if table == "financial_transactions" else table


def _properties(columns: str) -> str:
    pairs = {c.rpartition(" AS ")[2].strip(): c.rpartition(" AS ")[0].strip() or c.strip() for c in columns.split(",")}
    return "concat_ws('|', " + ", ".join(f"'{k}='||CAST({pairs[k]} AS VARCHAR)" for k in sorted(pairs)) + ")"


SQL["a10_entity_csvs"] = _with(" UNION ALL ".join(
    f"SELECT '{label}' AS label, '{label}:'||{key} AS id, {_properties(_KEPT[t])} AS properties FROM {_source(t)}"
    for label, key, t in [("Customer", "customer_id", "customers"), ("Employee", "employee_id", "employees"),
                          ("Product", "product_id", "products"), ("Transaction", "transaction_id", "financial_transactions"),
                          ("AuditLog", "log_id", "audit_logs")]),
    "customers", "employees", "products", "transactions", "audit_logs")
_TYPED = [("Customer", "customer_id", "customers"), ("Employee", "employee_id", "employees"), ("Product", "product_id", "products"),
          ("Transaction", "transaction_id", "financial_transactions"), ("AuditLog", "log_id", "audit_logs")]


def _header(columns: str) -> str:
    return ",".join(["id", *sorted(c.rpartition(" AS ")[2].strip() for c in columns.split(","))])


_COLUMN_PROPS = (f"{FQN}||table_name||'.'||column_name AS fqn, column_name AS name, table_name, data_type, is_nullable, ordinal_position, "
                 + ", ".join(TAG_FIELDS) + ", 'true' AS tagged, '2024-07-01 00:00:00' AS ingested_at")
_TABLE_PROPS = (f"{FQN}||table_name AS fqn, table_name AS name, '{SCHEMA}' AS schema_name, '{DATABASE}' AS database_name, "
                "'warehouse' AS source_platform, '2024-07-01 00:00:00' AS ingested_at")
_SCHEMA_PROPS = f"'{DATABASE}.{SCHEMA}' AS fqn, '{SCHEMA}' AS name, '{DATABASE}' AS database_name"
_DATABASE_PROPS = (f"'{DATABASE}' AS fqn, '{DATABASE}' AS name, 'warehouse' AS platform, 'Production' AS environment, "
                   "'2024-07-01 00:00:00' AS created_at")
_NAMED = {"Classification": (list(RANKS), "access_roles,color,description,name,requires_encryption,sensitivity_rank"),
          "Role": (ROLE_NAMES, "can_manage_policies,description,hierarchy_level,name"),
          "Policy": (MASKS + RULES, "applies_to,description,name,source_platform,type"),
          "AccessControlConfig": (["DEFAULT"], "check_pattern,created_at,name,version")}
SQL["a10_graph_csvs"] = _with(" UNION ALL ".join(
    [f"SELECT '{label}' AS label, '{label}:'||{key} AS id, '{_header(_KEPT[t])}' AS header, {_properties(_KEPT[t])} AS properties FROM {_source(t)}"
     for label, key, t in _TYPED]
    + [f"SELECT '{label}', '{label}:'||{key}, '{_header(p)}', {_properties(p)} FROM {t}" for label, key, p, t in [
        ("Column", f"{FQN}||table_name||'.'||column_name", _COLUMN_PROPS,
         "(SELECT * REPLACE (" + ", ".join(f"nullif({f},'') AS {f}" for f in TAG_FIELDS) + ") FROM catalog)"),      # Spark reads empty text of a CSV as NULL
        ("Table", f"{FQN}||table_name", _TABLE_PROPS, "(SELECT DISTINCT table_name FROM catalog)"),
        ("Schema", f"'{DATABASE}.{SCHEMA}'", _SCHEMA_PROPS, "(SELECT 1)"), ("Database", f"'{DATABASE}'", _DATABASE_PROPS, "(SELECT 1)")]]
    + [f"SELECT '{label}', '{label}:'||unnest({names}), 'id,{header}', CAST(NULL AS VARCHAR)" for label, (names, header) in _NAMED.items()]),
    "customers", "employees", "products", "transactions", "audit_logs", "catalog")
_VERTEX_IDS = " UNION ALL ".join(
    [f"SELECT '{label}:'||{key} AS id, '{label}' AS labels, {{none}} FROM {_source(t)}" for label, key, t in _TYPED]
    + [f"SELECT {COLUMN_ID}, 'Column', data_classification, data_owner, CAST(ordinal_position AS VARCHAR) FROM catalog",
       f"SELECT DISTINCT {TABLE_ID}, 'Table', {{none}} FROM catalog",
       f"SELECT 'Schema:{DATABASE}.{SCHEMA}', 'Schema', {{none}}", f"SELECT 'Database:{DATABASE}', 'Database', {{none}}"]
    + [f"SELECT '{label}:'||unnest({names}), '{label}', {{none}}" for label, (names, _) in _NAMED.items()])
_NONE = ("CAST(NULL AS VARCHAR) AS data_classification, CAST(NULL AS VARCHAR) AS data_owner, CAST(NULL AS VARCHAR) AS ordinal_position")
SQL["a12_round_trip_vertices"] = _with(_VERTEX_IDS.format(none=_NONE), "customers", "employees", "products", "transactions", "audit_logs", "catalog")
_TIER_OF = {"Customer": "Restricted", "Employee": "Restricted", "Product": "Restricted", "Transaction": "Restricted", "AuditLog": "Internal"}
SQL["a12_round_trip_edges"] = _with("SELECT src, dst, type, 0 AS n_props FROM (" + " UNION ALL ".join(
    [f"SELECT '{label}:'||{key} AS src, 'Classification:{_TIER_OF[label]}' AS dst, 'HAS_CLASSIFICATION' AS type FROM {_source(t)}" for label, key, t in _TYPED]
    + [f"SELECT {TABLE_ID}, {COLUMN_ID}, 'HAS_COLUMN' FROM catalog",
       f"SELECT DISTINCT 'Schema:{DATABASE}.{SCHEMA}', {TABLE_ID}, 'CONTAINS_TABLE' FROM catalog",
       f"SELECT 'Database:{DATABASE}', 'Schema:{DATABASE}.{SCHEMA}', 'CONTAINS_SCHEMA'",
       f"SELECT {COLUMN_ID}, 'Classification:'||data_classification, 'CLASSIFIED_AS' FROM catalog WHERE data_classification IN {TIER_IN}",
       f"SELECT 'Policy:'||policy_name, {COLUMN_ID}, 'MASKS' FROM policy_refs JOIN catalog USING (table_name, column_name) WHERE policy_kind='MASKING_POLICY'",
       "SELECT 'Employee:'||e.employee_id, 'Employee:'||m.employee_id, 'REPORTS_TO' FROM employees e JOIN employees m ON e.manager_id=m.employee_id",
       "SELECT 'Customer:'||c_custkey, 'Transaction:'||transaction_id, 'MADE_TRANSACTION' FROM transactions JOIN customer ON customer_id=c_custkey"]
    + [f"SELECT 'Role:{r}', 'Classification:{t}', 'CAN_ACCESS'" for r, ts in ROLE_TIERS.items() for t in ts]
    + [f"SELECT 'Role:{a}', 'Role:{b}', 'INHERITS_FROM'" for a, b in INHERITS]) + ")",
    "customers", "employees", "products", "transactions", "audit_logs", "catalog", "policy_refs")

# customers k and k + 1 are one where an order of k in 61 gives both; r holds the least reachable id of every customer
_IDENTITY = """WITH RECURSIVE l AS (
  SELECT DISTINCT o_custkey AS a, o_custkey+1 AS b FROM orders WHERE o_orderkey%61=0 AND EXISTS (SELECT 1 FROM customer WHERE c_custkey=o_custkey)
    AND EXISTS (SELECT 1 FROM customer WHERE c_custkey=o_custkey+1)),
reach(a, b) AS (SELECT c_custkey, c_custkey FROM customer
  UNION SELECT reach.a, x.t FROM reach JOIN (SELECT a AS f, b AS t FROM l UNION ALL SELECT b, a FROM l) x ON reach.b=x.f),
r AS (SELECT a AS k, min('Customer:'||b) AS id FROM reach GROUP BY a),
said AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey%61=0 OR o_orderkey%3=0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
  CASE WHEN o_orderkey%61=0 THEN 'c'||(o_custkey+1)||'@mail' WHEN o_orderkey%3=1 THEN 'c'||o_custkey||'@mail' END AS email,
  CASE WHEN o_orderkey%61<>0 AND o_orderkey%3=2 THEN '+'||lpad(CAST(o_custkey AS VARCHAR),12,'0') END AS phone,
  lpad(CAST(o_orderkey AS VARCHAR),12,'0') AS contact FROM orders)
"""
SQL["j12_resolved_vertices"] = _IDENTITY + """, n AS (SELECT r.id, max(customer_id) AS customer_id, max(email) AS email, max(phone) AS phone, max(contact) AS contact
  FROM said JOIN r ON r.k=o_custkey GROUP BY r.id)
SELECT s.id, CASE WHEN n.id IS NULL THEN 'Customer' ELSE 'Customer,Contact' END AS labels, coalesce(n.customer_id, CAST(c_custkey AS VARCHAR)) AS customer_id,
  coalesce(n.email, 'c'||c_custkey||'@mail') AS email, coalesce(n.phone, '+'||lpad(CAST(c_custkey AS VARCHAR),12,'0')) AS phone,
  c_mktsegment AS segment, n.contact
FROM (SELECT DISTINCT id FROM r) s JOIN customer ON s.id='Customer:'||c_custkey LEFT JOIN n ON n.id=s.id"""
SQL["j12_resolved_edges"] = _IDENTITY + """
SELECT DISTINCT r.id AS src, 'Nation:'||c_nationkey AS dst, 'LIVES_IN' AS type FROM customer JOIN r ON r.k=c_custkey
UNION ALL SELECT r.id, 'order:'||o_orderkey, 'PLACED' FROM orders JOIN r ON r.k=o_custkey"""
SQL["a11_snapshot_summary"] = f"SELECT rpad(kind||' '||name, 40, ' ')||CAST(n AS VARCHAR) AS line FROM ({_SUMMARY})"
SQL["b06_normalised_refs"] = _with(
    "SELECT upper(table_name) AS table_name, upper(column_name) AS column_name, upper(tag_name) AS tag_name, tag_value FROM assigned",
    "assigned")
SQL["c04_coerced_values"] = ("SELECT o_orderkey, TRY_CAST(substr(o_orderpriority,1,1) AS INT) AS level, "
                             "TRY_CAST(o_orderstatus AS BIGINT) AS code FROM orders")
SQL["c07_provenance"] = ("SELECT c_custkey AS customer_id, 'CUSTOMERS' AS source_table, 'warehouse' AS source_platform, "
                         "'2024-07-01 00:00:00' AS ingested_at FROM customer")

for _t, _cols in _KEPT.items():
    SQL[f"c06_minimise_{_t}"] = _with(f"SELECT {_cols} FROM {_source(_t)}", _source(_t))
for _name, _t, _more in [
    ("k05_customer_records", "customers",
     f"'Restricted' AS data_classification, '{_fields('CUSTOMERS', 'PII')}' AS pii_fields, "
     f"'{_fields('CUSTOMERS', 'Restricted')}' AS restricted_fields"),
    ("k06_employee_records", "employees",
     f"'Restricted' AS data_classification, '{_fields('EMPLOYEES', 'PII')}' AS pii_fields, "
     f"'{_fields('EMPLOYEES', 'Restricted')}' AS restricted_fields"),
    ("k07_product_records", "products",
     f"'Restricted' AS data_classification, '{_fields('PRODUCTS', 'Public')}' AS public_fields, "
     f"'{_fields('PRODUCTS', 'Restricted')}' AS restricted_fields"),
    ("k08_transaction_records", "financial_transactions",
     f"'Restricted' AS data_classification, '{_fields('FINANCIAL_TRANSACTIONS', 'Restricted')}' AS restricted_fields"),
    ("k09_audit_records", "audit_logs", "'Internal' AS data_classification"),
]:
    SQL[_name] = _with(f"SELECT {_KEPT[_t]}, {_more} FROM {_source(_t)}", _source(_t))

for _t, _r in [
    ("CUSTOMERS", "DATA_ANALYST"), ("CUSTOMERS", "HR_MANAGER"),
    ("EMPLOYEES", "DATA_ENGINEER"), ("EMPLOYEES", "HR_MANAGER"), ("EMPLOYEES", "DATA_ANALYST"),
    ("FINANCIAL_TRANSACTIONS", "DATA_ANALYST"), ("FINANCIAL_TRANSACTIONS", "FINANCE_ANALYST"),
    ("FINANCIAL_TRANSACTIONS", "GUEST"), ("AUDIT_LOGS", "SECURITY_AUDITOR"), ("AUDIT_LOGS", "FINANCE_ANALYST"),
]:
    SQL[f"e05_secure_{_t.lower()}_{_r.lower()}"] = _secured(_t, _r)
SQL["d08_masks_by_role_column"] = _with(
    f"SELECT log_id, reader_role, {_mask('email', 'user_email', 'reader_role')} AS user_email, "
    f"{_mask('ip', 'source_ip', 'reader_role')} AS source_ip FROM "
    f"(SELECT *, {_case('records_accessed%9', READERS)} AS reader_role FROM audit_logs)", "audit_logs")
SQL["e05_masked_amount_totals"] = _totals("FINANCIAL_TRANSACTIONS", "transactions", "amount", "transaction_amount")
SQL["e05_masked_salary_totals"] = _totals("EMPLOYEES", "employees", "salary", "salary")
_DECIDE = ("CASE WHEN a.role IS NULL THEN '{d}' ELSE '{g}' END AS access_decision FROM {src} q "
           "JOIN base_roles b ON q.role=b.base "
           "LEFT JOIN access a ON a.role=q.role AND a.classification=q.classification")
SQL["e10_bulk_decisions"] = _with(
    "SELECT q.request_id, q.role, q.classification AS classification_requested, "
    + _DECIDE.format(d="ACCESS DENIED: Role does not have permission", g="ACCESS GRANTED", src="requests"),
    "requests", "base_roles", "access")
SQL["e10_decision_counts"] = _with(
    "SELECT q.role, q.classification AS classification_requested, q.requests, "
    + _DECIDE.format(d="DENIED", g="GRANTED", src="(SELECT role, classification, count(*) AS requests FROM requests "
                                                 "GROUP BY ALL)"), "requests", "base_roles", "access")

SQL["g01_pivot_tags"] = _with("SELECT * FROM tags", "tags")
SQL["g01_column_catalog"] = _with("SELECT * FROM catalog", "catalog")
SQL["g02_tier_coverage"] = _with(
    "SELECT data_classification AS classification, count(*) AS column_count FROM tags "
    "WHERE data_classification IS NOT NULL GROUP BY 1", "tags")
_GOVERNED = "SELECT table_name FROM assigned UNION SELECT table_name FROM policy_refs WHERE policy_kind='ROW_ACCESS_POLICY'"
SQL["g08_governed_table_count"] = _with(f"SELECT count(*) AS governed_tables FROM ({_GOVERNED})",
                                        "assigned", "policy_refs")
SQL["j02_governed_tables"] = _with(_GOVERNED, "assigned", "policy_refs")
SQL["g10_table_tier"] = _with(
    "SELECT table_name, r AS sensitivity_rank, classification AS data_classification FROM "
    "(SELECT table_name, min(sensitivity_rank) AS r FROM catalog LEFT JOIN ranks ON data_classification=classification "
    "GROUP BY table_name) LEFT JOIN ranks ON r=sensitivity_rank", "catalog", "ranks")
SQL["g11_row_tier_counts"] = _with("SELECT node_type, classification, n AS node_count FROM row_counts", "row_counts")


def _diff(kinds: dict[str, str], how: str) -> str:
    """status/field rows of incoming against stored."""
    def new(f: str) -> str:
        return f"coalesce({_trim('i.' + f)},'')"

    def old(f: str) -> str:
        return f"coalesce({_trim('s.' + f)},'')"

    def differs(f: str) -> str:
        test = f"{new(f)}<>{old(f)}"
        return f"({test} AND NOT ({old(f)}='{kinds[f]}' AND {new(f)}=''))" if f in kinds else f"({test})"

    both = "i.table_name IS NOT NULL AND s.table_name IS NOT NULL"
    join = f"FROM incoming i {how} JOIN stored s ON i.table_name=s.table_name AND i.column_name=s.column_name"
    fqn = f"{FQN}||coalesce(i.table_name,s.table_name)||'.'||coalesce(i.column_name,s.column_name) AS fqn"
    nothing = "CAST(NULL AS VARCHAR)"
    rows = [f"SELECT {fqn}, 'changed' AS status, '{f}' AS field, coalesce(nullif({old(f)},''),'(none)') AS old_value, "
            f"coalesce(nullif({new(f)},''),'(none)') AS new_value {join} WHERE {both} AND {differs(f)}"
            for f in TAG_FIELDS]
    none_differ = " AND ".join(f"NOT {differs(f)}" for f in TAG_FIELDS)
    for status, test in [("new", "s.table_name IS NULL"), ("removed", "i.table_name IS NULL"),
                         ("unchanged", f"{both} AND {none_differ}")]:
        rows.append(f"SELECT {fqn}, '{status}', {nothing}, {nothing}, {nothing} {join} WHERE {test}")
    return " UNION ALL ".join(rows)


_CLASS_ONLY = {"data_classification": "Unclassified"}
_WITH_ENC = {**_CLASS_ONLY, "encryption_required": "No"}
SQL["j03_tag_diff"] = _with(_diff(_CLASS_ONLY, "LEFT"), "incoming", "stored")
SQL["j03_tag_diff_full"] = _with(_diff(_WITH_ENC, "FULL"), "incoming", "stored")
SQL["j03_diff_summary"] = _with(
    "SELECT count(*) FILTER (status='new') AS new, count(*) FILTER (status='changed') AS changed, "
    "count(*) FILTER (status='unchanged') AS unchanged, count(*) FILTER (status='removed') AS removed "
    f"FROM ({_diff(_CLASS_ONLY, 'FULL')})", "incoming", "stored")


def _changes(new: str, old: str | None) -> str:
    rows = []
    for f in TAG_FIELDS:
        was = f"o.{f}" if old else "CAST(NULL AS VARCHAR)"
        join = f"LEFT JOIN {old} o USING (table_name, column_name)" if old else ""
        rows.append(f"SELECT table_name, column_name, '{f.upper()}' AS tag_field, {was} AS old_value, "
                    f"c.{f} AS new_value, 'PENDING' AS sync_status FROM {new} c {join} "
                    f"WHERE coalesce({was},'')<>coalesce(c.{f},'')")
    return " UNION ALL ".join(rows)


SQL["j04_tag_changes"] = _with(_changes("tags", "old_tags"), "tags", "old_tags")
SQL["j11_pending_changes"] = _with(
    f"SELECT table_name, column_name, tag_field, old_value, new_value FROM ({_changes('tags', 'old_tags')})",
    "tags", "old_tags")
# the state of a column and tag after each delivery that names it is the last statement of all deliveries so far
SQL["n02_stream_drift"] = _with(
    "SELECT strftime(TIMESTAMP '2024-07-01' + to_minutes(CAST(delivery AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS changed_at, table_name, column_name, "
    "upper(tag_name) AS tag_field, was.v AS old_value, now.v AS new_value, 'PENDING' AS sync_status FROM ("
    "SELECT *, max(e) OVER (so_far ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS now, "
    "max(e) OVER (so_far ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM ("
    "SELECT table_name, column_name, tag_name, statement_id % 10 AS delivery, "
    "max({'a': assigned_at, 's': statement_id, 'l': line, 'v': tag_value}) AS e FROM history GROUP BY 1, 2, 3, 4) "
    "WINDOW so_far AS (PARTITION BY table_name, column_name, tag_name ORDER BY delivery)) "
    "WHERE coalesce(was.v,'')<>coalesce(now.v,'')", "history")
SQL["j05_snapshot_refresh"] = _with(
    "SELECT coalesce(o.table_name,t.table_name) AS table_name, coalesce(o.column_name,t.column_name) AS column_name, "
    + ", ".join(f"CASE WHEN t.table_name IS NOT NULL THEN t.{f} ELSE o.{f} END AS {f}" for f in TAG_FIELDS)
    + ", t.table_name IS NOT NULL AS refreshed FROM old_tags o FULL JOIN "
      "(SELECT tags.* FROM tags SEMI JOIN live USING (table_name, column_name)) t "
      "ON o.table_name=t.table_name AND o.column_name=t.column_name", "old_tags", "tags", "live")
CTE["intervals"] = """intervals AS (
  SELECT table_name, column_name, tag_field, value, since AS valid_from, lead(since) OVER (PARTITION BY table_name, column_name, tag_field ORDER BY since) AS valid_to
  FROM (SELECT *, lag(value) OVER w AS was, row_number() OVER w AS nth FROM (
      SELECT table_name, column_name, upper(tag_name) AS tag_field, assigned_at AS since, arg_max({'v': tag_value}, [statement_id, line]).v AS value
      FROM history GROUP BY 1, 2, 3, 4) WINDOW w AS (PARTITION BY table_name, column_name, tag_field ORDER BY since))
  WHERE nth=1 OR value IS DISTINCT FROM was)"""
NEEDS["intervals"] = ["history"]
_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"
SQL["j11_column_history"] = _with(
    f"SELECT table_name, column_name, tag_field, value, {_TIME.format('valid_from')} AS valid_from, {_TIME.format('valid_to')} AS valid_to FROM intervals",
    "intervals")
SQL["j11_catalog_at"] = _with(
    f"SELECT m.table_name, m.column_name, {_TIME.format('m.moment')} AS moment, "
    + ", ".join(f"max(CASE WHEN tag_field='{f.upper()}' THEN value END) AS {f}" for f in TAG_FIELDS)
    + f" FROM (SELECT DISTINCT {LINE_TABLE} AS table_name, {LINE_COLUMN} AS column_name, date_trunc('quarter', l_shipdate) AS moment FROM lineitem) m "
      "LEFT JOIN intervals i ON m.table_name=i.table_name AND m.column_name=i.column_name AND m.moment>=i.valid_from "
      "AND (i.valid_to IS NULL OR m.moment<i.valid_to) GROUP BY ALL", "intervals")
_PAIR = "ON o.table_name=n.table_name AND o.column_name=n.column_name"
_ID = (f"'Column:'||{FQN}||coalesce(o.table_name,n.table_name)||'.'||coalesce(o.column_name,n.column_name)")
SQL["j06_merged_vertices"] = _with(
    f"SELECT {_ID} AS id, coalesce(n.data_classification,o.data_classification) AS data_classification, "
    "coalesce(o.data_owner,n.data_owner) AS data_owner, "
    "CASE WHEN n.table_name IS NOT NULL THEN '1' END AS sync_version "
    f"FROM stored o FULL JOIN incoming_filled n {_PAIR}", "stored", "incoming_filled")
SQL["j07_merged_edges"] = _with(
    f"SELECT DISTINCT {COLUMN_ID} AS src, 'Classification:'||data_classification AS dst, 'CLASSIFIED_AS' AS type FROM "
    "(SELECT table_name, column_name, data_classification FROM stored UNION ALL "
    f"SELECT table_name, column_name, data_classification FROM incoming_filled) WHERE data_classification IN {TIER_IN}",
    "stored", "incoming_filled")
_TOUCHED = " OR ".join(f"n.{f} IS DISTINCT FROM o.{f}" for f in TAG_FIELDS)
SQL["j10_sync_result"] = _with(
    f"SELECT {FQN}||coalesce(o.table_name,n.table_name)||'.'||coalesce(o.column_name,n.column_name) AS fqn, "
    + ", ".join(f"coalesce(n.{f},o.{f}) AS {f}" for f in TAG_FIELDS)
    + f", CAST(CASE WHEN o.table_name IS NULL THEN 1 WHEN n.table_name IS NULL THEN 1 WHEN {_TOUCHED} THEN 2 ELSE 1 END "
      f"AS BIGINT) AS sync_version FROM stored o FULL JOIN incoming_filled n {_PAIR}", "stored", "incoming_filled")
_BOTH = ("both_states AS (SELECT coalesce(o.table_name,n.table_name) AS table_name, coalesce(n.data_classification,"
         f"o.data_classification) AS tier FROM stored o FULL JOIN incoming_filled n {_PAIR})")
CTE["both_states"] = _BOTH
NEEDS["both_states"] = ["stored", "incoming_filled"]
SQL["j10_synced_edges"] = _with(
    "SELECT 'CONTAINS_SCHEMA' AS type, 1 AS n UNION ALL SELECT 'CONTAINS_TABLE', count(DISTINCT table_name) FROM both_states "
    f"UNION ALL SELECT 'HAS_COLUMN', count(*) FROM both_states UNION ALL "
    f"SELECT 'CLASSIFIED_AS', count(*) FROM both_states WHERE tier IN {TIER_IN}", "both_states")
SQL["j10_synced_chain"] = _with(
    f"SELECT 'Database:{DATABASE}' AS id, 'Database' AS labels UNION ALL SELECT 'Schema:{DATABASE}.{SCHEMA}', 'Schema' "
    f"UNION ALL SELECT DISTINCT {TABLE_ID}, 'Table' FROM both_states", "both_states")
SQL["n01_stream_sync"] = _with(
    f"SELECT {FQN}||table_name||'.'||column_name AS fqn, data_classification, data_category, encryption_required, "
    "retention_policy, data_owner FROM catalog", "catalog")

SQL["k01_catalog_edges"] = _with(
    f"SELECT 'Database:{DATABASE}' AS src, 'Schema:{DATABASE}.{SCHEMA}' AS dst, 'CONTAINS_SCHEMA' AS type UNION ALL "
    f"SELECT DISTINCT 'Schema:{DATABASE}.{SCHEMA}', {TABLE_ID}, 'CONTAINS_TABLE' FROM catalog UNION ALL "
    f"SELECT {TABLE_ID}, {COLUMN_ID}, 'HAS_COLUMN' FROM catalog", "catalog")
SQL["k04_classified_as"] = _with(
    f"SELECT {COLUMN_ID} AS src, 'Classification:'||data_classification AS dst, 'CLASSIFIED_AS' AS type FROM catalog "
    f"WHERE data_classification IN {TIER_IN}", "catalog")
SQL["k06_reports_to"] = _with(
    "SELECT 'Employee:'||e.employee_id AS src, 'Employee:'||m.employee_id AS dst, 'REPORTS_TO' AS type "
    "FROM employees e JOIN employees m ON e.manager_id=m.employee_id", "employees")
SQL["k08_made_transaction"] = _with(
    "SELECT 'Customer:'||c_custkey AS src, 'Transaction:'||transaction_id AS dst, 'MADE_TRANSACTION' AS type "
    "FROM transactions JOIN customer ON customer_id=c_custkey", "transactions")
SQL["k08_has_classification"] = _with(
    "SELECT 'Transaction:'||transaction_id AS src, 'Classification:Restricted' AS dst, 'HAS_CLASSIFICATION' AS type "
    "FROM transactions", "transactions")
SQL["k10_masks"] = _with(
    f"SELECT 'Policy:'||policy_name AS src, {COLUMN_ID} AS dst, 'MASKS' AS type FROM policy_refs "
    "JOIN catalog USING (table_name, column_name) WHERE policy_kind='MASKING_POLICY'", "policy_refs", "catalog")

SQL["m01_role_tiers"] = _with(
    "SELECT role, level, description, string_agg(classification, ',' ORDER BY classification) AS "
    "accessible_classifications FROM teams JOIN team_access ON name=role GROUP BY role, level, description",
    "teams", "team_access")
SQL["m02_records_by_tier"] = _with(
    "SELECT node_type, classification, n AS count, sensitivity_rank FROM counts JOIN ranks USING (classification)",
    "counts", "ranks")
SQL["m03_column_listing"] = _with(
    f"SELECT table_name, column_name, data_type, ordinal_position, {', '.join(TAG_FIELDS)} FROM catalog", "catalog")
SQL["m04_policy_columns"] = _with(
    "SELECT policy_name AS policy, type AS policy_type, table_name, column_name, data_classification AS classification "
    "FROM policy_refs JOIN policies ON policy_name=name JOIN catalog USING (table_name, column_name) "
    "WHERE policy_kind='MASKING_POLICY'", "policy_refs", "policies", "catalog")
_SEEN = ("SELECT role, node_type, CAST(sum(n) AS BIGINT) AS accessible_nodes, "
         "string_agg(DISTINCT classification, ',' ORDER BY classification) AS classifications "
         "FROM {c} JOIN access USING (classification) GROUP BY role, node_type")
SQL["m05_visible_by_role"] = _with(_SEEN.format(c="counts"), "counts", "access")
SQL["m05_visible_by_role_row_tier"] = _with(_SEEN.format(c="row_counts"), "row_counts", "access")


def _gate(select: str, source: str, role: str, tier: str = "Restricted") -> str:
    return _with(f"SELECT {select}, '{role}' AS accessing_as FROM {source} WHERE EXISTS "
                 f"(SELECT 1 FROM access WHERE role='{role}' AND classification='{tier}')", source, "access")


_CUST = "customer_id, first_name, last_name, city, customer_tier, 'Restricted' AS data_classification"
SQL["m06_customer_list"] = _gate(_CUST, "customers", "FINANCE_ANALYST")
SQL["m07_transaction_list"] = _gate(
    "transaction_id, merchant_name, merchant_category, fraud_flag, status, 'Restricted' AS data_classification",
    "transactions", "FINANCE_ANALYST")
_NODES = ("nodes AS (SELECT 'Customer' AS node_type, CAST(c_custkey AS VARCHAR) AS node_id, 'Restricted' AS classification "
          "FROM customer UNION ALL SELECT 'Employee', CAST(s_suppkey AS VARCHAR), 'Restricted' FROM supplier "
          "UNION ALL SELECT 'Product', CAST(p_partkey AS VARCHAR), 'Restricted' FROM part "
          f"UNION ALL SELECT 'Transaction', 'txn-'||{_pad('o_orderkey', 12)}, 'Restricted' FROM orders "
          f"UNION ALL SELECT 'AuditLog', 'log-'||{_pad('event_id', 12)}, 'Internal' FROM events)")
CTE["nodes"] = _NODES


def _sample(role: str) -> str:
    return _with(f"SELECT node_type, node_id, classification FROM nodes JOIN access USING (classification) "
                 f"WHERE role='{role}'", "nodes", "access")


SQL["m08_visible_sample"] = _sample("DATA_ANALYST")
_REACH = "(SELECT classification FROM access WHERE role='{r}')"
_HR = f"FROM catalog WHERE data_classification IN {_REACH.format(r='HR_MANAGER')}"
SQL["m09_accessible_columns"] = _with(
    f"SELECT table_name, column_name, data_classification AS classification, data_owner {_HR}", "catalog", "access")
SQL["m09_accessible_column_lists"] = _with(
    "SELECT 'HR_MANAGER' AS role, table_name, column_name||' ('||data_classification||')' AS accessible_column, "
    f"count(*) OVER (PARTITION BY table_name) AS accessible_column_count {_HR}", "catalog", "access")
SQL["m10_column_visibility"] = _with(
    "SELECT table_name, column_name, data_classification AS classification, CASE WHEN data_classification IN "
    f"{_REACH.format(r='HR_MANAGER')} THEN 'VISIBLE' ELSE 'MASKED / NO ACCESS' END AS access_decision, "
    "'HR_MANAGER' AS role FROM catalog", "catalog", "access")
SQL["m11_engineer_employees"] = _gate(
    "employee_id AS id, first_name, last_name, department, job_title, 'VISIBLE (Restricted)' AS salary_note, "
    "'VISIBLE (Restricted)' AS ssn_note", "employees", "DATA_ENGINEER")
SQL["m12_column_decisions"] = _with(
    "SELECT table_name, column_name, data_classification AS classification, CASE data_classification "
    "WHEN 'Public' THEN 'VISIBLE - No masking' WHEN 'Internal' THEN 'VISIBLE - No masking' "
    "WHEN 'Restricted' THEN 'VISIBLE - Masking policy applies' ELSE 'BLOCKED' END AS access_decision "
    f"FROM catalog WHERE data_classification IN {_REACH.format(r='FINANCE_ANALYST')}", "catalog", "access")
SQL["m13_role_chains"] = (
    f"WITH RECURSIVE {CTE['team_tree']}, walk AS (SELECT parent||','||child AS role_chain, child AS node FROM team_tree "
    "WHERE parent NOT IN (SELECT child FROM team_tree) UNION ALL "
    "SELECT role_chain||','||child, child FROM walk JOIN team_tree ON parent=node) SELECT role_chain FROM walk")
SQL["m14_roles_for_tier"] = _with(
    "SELECT name AS role, description, level FROM teams WHERE base IN "
    "(SELECT role FROM access WHERE classification='Restricted')", "teams", "access")
_LINEAGE = ("SELECT classification, node_type, max(n) AS node_count, string_agg(role, ',' ORDER BY role) AS "
            "roles_with_access FROM {c} JOIN access USING (classification) WHERE classification IN ({t}) "
            "GROUP BY classification, node_type")
SQL["m16_sensitive_lineage"] = _with(_LINEAGE.format(c="counts", t="'Restricted'"), "counts", "access")
SQL["m16_sensitive_lineage_row_tier"] = _with(_LINEAGE.format(c="row_counts", t="'Restricted','PII'"),
                                              "row_counts", "access")
SQL["m17_pii_exposure"] = _with(
    "SELECT table_name, column_name AS pii_column, count(*) OVER (PARTITION BY table_name) AS pii_column_count "
    "FROM catalog WHERE data_classification='PII'", "catalog")
SQL["m17_pii_exposure_known_tables"] = _with(
    "SELECT table_name, column_name AS pii_column, count(*) OVER (PARTITION BY table_name) AS pii_column_count "
    "FROM catalog WHERE data_classification='PII' AND table_name IN "
    "(SELECT table_name FROM policy_refs WHERE policy_status='ACTIVE')", "catalog", "policy_refs")
for _r in ("DATA_ENGINEER", "HR_MANAGER", "DATA_ANALYST"):
    SQL[f"m35_masked_sample_{_r.lower()}"] = (
        f"SELECT employee_id, first_name, last_name, email, ssn, salary FROM ({_secured('EMPLOYEES', _r)})")
_RISK = "SELECT table_name, column_name, data_classification AS classification, '{w}' AS warning FROM {s} WHERE " \
        "data_classification IN ('Restricted','PII') AND {c}"
SQL["m18_encryption_gaps"] = _with(_RISK.format(
    w="COMPLIANCE RISK: Sensitive column not marked for encryption", s="catalog", c="encryption_required='No'"), "catalog")
SQL["m18_encryption_gaps_null"] = _with(_RISK.format(
    w="COMPLIANCE RISK: encryption not enforced", s="inventory JOIN tags USING (table_name, column_name)",
    c="(encryption_required IS NULL OR encryption_required='No')"), "inventory", "tags")


def _owners(where: str) -> str:
    return _with("SELECT data_owner AS owner_team, table_name||'.'||column_name AS owned_column, "
                 f"count(*) OVER (PARTITION BY data_owner) AS column_count FROM catalog WHERE {where}", "catalog")


SQL["m19_owners"] = _owners("data_owner<>''")
SQL["m19_owners_with_empty"] = _owners("data_owner IS NOT NULL")
SQL["m20_customer_access_audit"] = _with(
    "SELECT 'FINANCE_ANALYST' AS role, customer_id, transaction_id, merchant_name AS merchant, "
    "merchant_category AS category, 'ACCESSIBLE (amount masked by policy)' AS amount_access, "
    "'Restricted' AS classification_granted FROM transactions JOIN customer ON customer_id=c_custkey WHERE "
    "EXISTS (SELECT 1 FROM access WHERE role='FINANCE_ANALYST' AND classification='Restricted')", "transactions", "access")
SQL["m21_visible_subgraph"] = _with(
    "SELECT role, classification, node_type, node_id FROM nodes JOIN access USING (classification) "
    "WHERE node_type IN ('Customer','Employee')", "nodes", "access")
SQL["m21_column_tier_pairs"] = _with(
    f"SELECT table_name, column_name, data_classification AS classification FROM catalog WHERE data_classification "
    f"IN {TIER_IN}", "catalog")
SQL["m22_management_paths"] = (
    f"WITH RECURSIVE {CTE['places']}, {CTE['employees']}, up AS (SELECT e.employee_id AS s, m.employee_id AS d "
    "FROM employees e JOIN employees m ON e.manager_id=m.employee_id), "
    "walk AS (SELECT employee_id AS start, employee_id AS node, CAST(employee_id AS VARCHAR) AS path, 0 AS hops FROM employees "
    "UNION ALL SELECT start, d, path||','||d, hops+1 FROM walk JOIN up ON node=s WHERE hops<3) "
    "SELECT start, path, hops FROM walk WHERE node NOT IN (SELECT s FROM up)")
SQL["m23_customer_transactions"] = _with(
    "SELECT customer_id, transaction_id FROM transactions JOIN customer ON customer_id=c_custkey", "transactions")
SQL["m24_catalog_paths"] = _with(
    f"SELECT '{DATABASE},{SCHEMA},'||table_name||','||column_name AS path FROM catalog", "catalog")
SQL["m24_table_column_counts"] = _with(
    f"SELECT table_name, {FQN}||table_name AS fqn, count(*) AS column_count FROM catalog GROUP BY table_name", "catalog")
SQL["m25_tier_counts"] = _with(
    "SELECT classification, sensitivity_rank, count(*) AS column_count FROM catalog "
    "JOIN ranks ON data_classification=classification GROUP BY ALL", "catalog", "ranks")
SQL["m26_restricted_columns"] = _with(
    "SELECT table_name, column_name, data_owner AS owner_team, encryption_required, retention_policy FROM catalog "
    "WHERE data_classification='Restricted'", "catalog")
SQL["m28_role_hierarchy"] = _with(
    "SELECT name AS role, child AS parent FROM teams LEFT JOIN team_tree ON name=team_tree.parent", "teams", "team_tree")
SQL["m29_role_restricted_columns"] = _with(
    "SELECT role, classification, table_name, column_name FROM catalog JOIN access ON data_classification=classification "
    "WHERE classification='Restricted'", "catalog", "access")
SQL["m30_reachable_transactions"] = _with(
    "SELECT 'FINANCE_ANALYST' AS role, n AS accessible_transactions, classification AS via_classification, "
    "'Amount masked by amount_masking_policy' AS note FROM counts WHERE node_type='Transaction' AND classification IN "
    + _REACH.format(r="FINANCE_ANALYST"), "counts", "access")
SQL["m31_policy_lineage"] = _with(
    "SELECT 'FINANCE_ANALYST' AS role, data_classification AS classification, table_name, column_name, "
    "policy_name AS masking_policy FROM catalog JOIN policy_refs USING (table_name, column_name) "
    f"WHERE policy_kind='MASKING_POLICY' AND data_classification IN {_REACH.format(r='FINANCE_ANALYST')}",
    "catalog", "policy_refs", "access")
SQL["m32_security_picture"] = _with(
    "SELECT role, classification, table_name, column_name, policy_name AS masking_policy FROM catalog "
    "JOIN access ON data_classification=classification LEFT JOIN (SELECT * FROM policy_refs WHERE "
    "policy_kind='MASKING_POLICY') USING (table_name, column_name)", "catalog", "policy_refs", "access")
_ENC = ("SELECT table_name, column_name, {c} AS classification, {o} AS data_owner FROM tags "
        "WHERE encryption_required='Yes'")
SQL["m33_encryption_columns"] = _with(_ENC.format(c="CAST(NULL AS VARCHAR)", o="CAST(NULL AS VARCHAR)"), "tags")
SQL["m33_encryption_columns_pivoted"] = _with(_ENC.format(c="data_classification", o="data_owner"), "tags")
SQL["m34_tag_listing"] = _with(
    "SELECT table_name, column_name, upper(tag_name) AS tag_name, tag_value FROM assigned", "assigned")
SQL["n03_stream_secure"] = _secured("AUDIT_LOGS", "DATA_ANALYST")
