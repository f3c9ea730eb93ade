"""Ten rows per governed table.

Names, dates and the like follow a rule; the few values that golden results rest
on (amounts, who bought, who reports to whom, the one inactive / terminated /
fraudulent row) are fixed.
"""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from functools import cached_property

from pyspark.sql import functions as F

from tierwarden.model import (
    CATALOG_SCHEMA, TIER_SHEET, can_access_df, local_df, policies_df, policy_refs_df, roles_df, sheet_tag_refs,
)
from tierwarden.operators import catalog as C
from tierwarden.operators import graph as G
from tierwarden.sources.inventory import catalog_from_schemas

# Fixed values.
AMOUNTS = "1250.00 89.99 5000.00 45.50 2200.00 750.00 15000.00 320.00 99.00 12500.00".split()
BUYERS = [1001, 1002, 1003, 1001, 1004, 1005, 1006, 1007, 1008, 1003]
MANAGERS = [5010, 5011, 5012, 5010, 5013, 5001, 5010, 5002, 5001, None]
INACTIVE, TERMINATED, FRAUD, RETIRED = 1005, 5008, "txn-uuid-0010", 110
FAILED_LOGS = {2, 4, 8}
SERVICE_LOGS = {6, 10}

DDL = {
    "CUSTOMERS": "customer_id long, first_name string, last_name string, email string, phone string, "
                 "date_of_birth date, ssn string, address_line1 string, address_line2 string, city string, "
                 "state string, zip_code string, country string, customer_tier string, "
                 "created_at timestamp_ntz, is_active boolean",
    "FINANCIAL_TRANSACTIONS": "transaction_id string, customer_id long, account_number string, "
                              "routing_number string, card_last_four string, transaction_amount decimal(12,2), "
                              "transaction_type string, merchant_name string, merchant_category string, "
                              "transaction_date timestamp_ntz, currency string, status string, "
                              "fraud_flag boolean, ip_address string, device_fingerprint string",
    "EMPLOYEES": "employee_id long, employee_number string, first_name string, last_name string, email string, "
                 "personal_email string, phone string, ssn string, date_of_birth date, hire_date date, "
                 "termination_date date, department string, job_title string, manager_id long, "
                 "salary decimal(12,2), bonus decimal(12,2), bank_account string, performance_rating string, "
                 "location_office string, remote_work boolean, clearance_level string",
    "PRODUCTS": "product_id long, product_sku string, product_name string, product_description string, "
                "category string, subcategory string, unit_price decimal(10,2), cost_price decimal(10,2), "
                "profit_margin decimal(5,2), stock_quantity long, reorder_threshold long, supplier_id string, "
                "is_active boolean, launch_date date, last_modified timestamp_ntz",
    "AUDIT_LOGS": "log_id string, event_timestamp timestamp_ntz, user_id string, user_email string, "
                  "source_ip string, action_type string, resource_accessed string, data_classification string, "
                  "success_flag boolean, failure_reason string, session_id string, user_agent string, "
                  "records_accessed long, query_hash string",
}
TS = datetime(2024, 1, 15, 9, 0)


def _customer(i: int) -> tuple:
    key = 1000 + i
    return (key, f"First{i}", f"Last{i}", f"c{i}@email.example", f"555-01{i:02d}", date(1980, 1, i),
            f"{i:03d}-45-{6000 + i}", f"{i} Oak Street", f"Apt {i}" if i % 2 == 0 else None, f"City{i}", "TX",
            f"{78700 + i}", "USA", "Gold", TS, key != INACTIVE)


def _transaction(i: int) -> tuple:
    key = f"txn-uuid-{i:04d}"
    return (key, BUYERS[i - 1], f"ACC-{BUYERS[i - 1]}0000{i}", "021000021", f"{4000 + i}",
            Decimal(AMOUNTS[i - 1]), "Purchase", f"Shop{i}", "Retail", TS, "USD", "Completed", key == FRAUD,
            f"10.0.0.{i}", f"fp-{i}")


def _employee(i: int) -> tuple:
    key = 5000 + i
    return (key, f"EMP-{i:03d}", f"First{i}", "O'Brien" if i == 4 else f"Last{i}", f"e{i}@company.example",
            f"e{i}@mail.example", f"555-10{i:02d}", f"{i:03d}-22-{3000 + i}", date(1985, 2, i), date(2015, 3, i),
            date(2024, 6, 30) if key == TERMINATED else None, "Engineering", "Engineer", MANAGERS[i - 1],
            Decimal(90000 + 1000 * i), Decimal(5000 + 100 * i), f"BANK-{i:03d}", "Good", "HQ", i % 2 == 0,
            f"Level {i % 5}")


def _product(i: int) -> tuple:
    key = 100 + i
    return (key, f"SKU-{i}", 'Laptop 15"' if i == 1 else f"Product {i}", "text", "Electronics", "Parts",
            Decimal("99.99"), Decimal("45.00"), Decimal("55.00"), 10 * i, i, "SUP-001", key != RETIRED,
            date(2023, 1, i), TS)


def _log(i: int) -> tuple:
    return (f"log-{i:03d}", TS, f"user:{i}", None if i in SERVICE_LOGS else f"e{i}@company.example",
            f"10.0.1.{i}", "SELECT", "customers.*", "PII", i not in FAILED_LOGS,
            "Denied" if i in FAILED_LOGS else None, f"sess-{i}", "Agent/1.0", i, f"qh-{i}")


ROWS = {"CUSTOMERS": _customer, "FINANCIAL_TRANSACTIONS": _transaction, "EMPLOYEES": _employee,
        "PRODUCTS": _product, "AUDIT_LOGS": _log}


# The reduced data set - its 42 columns and the rows it keeps.
SMALL_COLUMNS = {
    "CUSTOMERS": "CUSTOMER_ID FIRST_NAME LAST_NAME EMAIL PHONE SSN CITY COUNTRY CUSTOMER_TIER IS_ACTIVE",
    "EMPLOYEES": "EMPLOYEE_ID FIRST_NAME LAST_NAME EMAIL SSN SALARY BONUS DEPARTMENT LOCATION_OFFICE CLEARANCE_LEVEL",
    "FINANCIAL_TRANSACTIONS": "TRANSACTION_ID ACCOUNT_NUMBER TRANSACTION_AMOUNT FRAUD_FLAG MERCHANT_CATEGORY "
                              "CURRENCY IP_ADDRESS",
    "PRODUCTS": "PRODUCT_ID PRODUCT_SKU PRODUCT_NAME PRODUCT_DESCRIPTION CATEGORY SUBCATEGORY LAUNCH_DATE "
                "COST_PRICE PROFIT_MARGIN UNIT_PRICE",
    "AUDIT_LOGS": "LOG_ID USER_EMAIL SOURCE_IP ACTION_TYPE SUCCESS_FLAG",
}
SMALL_ROWS = {"CUSTOMERS": [1, 2, 3, 4, 5], "EMPLOYEES": [1, 2, 10, 8], "PRODUCTS": [1, 2, 3],
              "FINANCIAL_TRANSACTIONS": [1, 2, 10], "AUDIT_LOGS": [1, 2, 8]}
SMALL_MANAGERS = {5001: 5010, 5002: 5010, 5008: 5002}


class SmallFixture:
    """Few columns and rows; sources lack most of the columns a record could have."""

    def __init__(self, spark):
        self.spark = spark
        self.policy_refs = policy_refs_df(spark)

    @cached_property
    def entities(self):
        out = {}
        for table, picked in SMALL_ROWS.items():
            df = self.spark.createDataFrame([ROWS[table](i) for i in picked], DDL[table])
            if table == "EMPLOYEES":
                links = F.create_map(*[F.lit(x) for pair in SMALL_MANAGERS.items() for x in pair])
                df = df.withColumn("manager_id", links[F.col("employee_id").cast("int")].cast("long"))
            drop = {"CUSTOMERS": ["ssn", "phone"], "EMPLOYEES": ["ssn", "salary", "bonus"],
                    "PRODUCTS": ["cost_price"], "FINANCIAL_TRANSACTIONS": ["transaction_amount"],
                    "AUDIT_LOGS": ["source_ip"]}[table]
            out[table] = df.drop(*drop)
        return out

    @cached_property
    def catalog(self):
        tiers = {(t, c): tier for t, by in TIER_SHEET.items() for tier, names in by.items() for c in names}
        rows = []
        for table, names in SMALL_COLUMNS.items():
            for i, c in enumerate(names.split(), 1):
                tier = tiers[(table, c)]
                rows.append((table, c, "VARCHAR", "YES", i, tier, None,
                             "Yes" if tier in ("Restricted", "PII") else "No",
                             "7_years" if tier == "Restricted" else None,
                             "Compliance Team" if tier == "Restricted" else None))
        return C.fill_tag_defaults(local_df(self.spark, rows, CATALOG_SCHEMA))


class Fixture:
    def __init__(self, spark):
        self.spark = spark

    @cached_property
    def entities(self):
        return {t: self.spark.createDataFrame([make(i) for i in range(1, 11)], DDL[t]).cache()
                for t, make in ROWS.items()}

    @cached_property
    def refs(self):
        """108 short tag references, names in upper case."""
        return self.sheet.selectExpr("object_name AS table_name", "column_name", "tag_name", "tag_value")

    @cached_property
    def sheet(self):
        return sheet_tag_refs(self.spark)

    @cached_property
    def inventory(self):
        return catalog_from_schemas(self.spark, self.entities)

    @cached_property
    def raw_catalog(self):
        picked = self.inventory.select("table_schema", "table_name", "column_name", "data_type", "is_nullable",
                                       "ordinal_position")
        return C.column_catalog(C.pivot_tags(self.refs), picked, "DEMO_SCHEMA").cache()

    @cached_property
    def catalog(self):
        return C.fill_tag_defaults(self.raw_catalog).cache()

    @cached_property
    def roles(self):
        return roles_df(self.spark)

    @cached_property
    def access(self):
        return can_access_df(self.spark)

    @cached_property
    def policies(self):
        return policies_df(self.spark)

    @cached_property
    def policy_refs(self):
        return policy_refs_df(self.spark)

    @cached_property
    def records(self):
        from tierwarden.model import LABEL_OF
        return {LABEL_OF[t]: G.records(df, t) for t, df in self.entities.items()}
