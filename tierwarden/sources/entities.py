"""The five governed tables derived from the star-schema test tables.

Every derivation is a deterministic expression over one row (plus the two
fixed-size geography tables), so Spark prunes the columns a query does not use
and nothing is shuffled to build an entity.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwarden.model import ABSENT_DEFAULTS, KEPT_COLUMNS, LABEL_OF
from tierwarden.functions.text import or_false
from tierwarden.sources.raw import read_raw


def _pad(col: Column | str, width: int) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.lpad(col.cast("string"), width, "0")


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _str(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def _money(col: Column, precision: int = 12) -> Column:
    return col.cast(f"decimal({precision},2)")


def _day(base: str, days: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), days.cast("int"))


def _ssn(key: str) -> Column:
    digits = _pad(key, 9)
    shown = _text(F.substring(digits, 1, 3), "-", F.substring(digits, 4, 2), "-", F.substring(digits, 6, 4))
    return F.when(F.col(key) % 11 != 10, shown)


def _ip(prefix: str, key: str) -> Column:
    k = F.col(key)
    return _text(prefix, _str(F.floor(k / 256) % 256), ".", _str(k % 256))


class Entities:
    """Governed tables over one directory of Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_raw(self.spark, self.dir, name)

    @cached_property
    def places(self) -> DataFrame:
        """nation x region: 25 rows at every scale.

        Made unique on its key, which lets the optimizer drop the whole join from
        queries that use no geography column.
        """
        return (self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                .select("n_nationkey", "n_name", "r_name").dropDuplicates(["n_nationkey"]))

    @cached_property
    def customers(self) -> DataFrame:
        k = F.col("c_custkey")
        df = self.raw("customer").join(self.places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        return df.select(
            k.alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            _text(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), "@", F.lower("c_mktsegment"),
                  ".example").alias("email"),
            _text("555-", _pad(k % 10000, 4)).alias("phone"),
            _day("1950-01-01", k % 18000).alias("date_of_birth"),
            _ssn("c_custkey").alias("ssn"),
            _text(_str(k), " ", F.col("r_name"), " Street").alias("address_line1"),
            F.when(k % 3 == 0, _text("Unit ", _str(k % 100))).alias("address_line2"),
            F.col("n_name").alias("city"),
            _text("S", _str("n_nationkey")).alias("state"),
            _pad(k % 100000, 5).alias("zip_code"),
            F.col("r_name").alias("country"),
            F.col("c_mktsegment").alias("customer_tier"),
            _day("2015-01-01", k % 3000).cast("timestamp_ntz").alias("created_at"),
            (F.col("c_acctbal") >= 0).alias("is_active"))

    @cached_property
    def transactions(self) -> DataFrame:
        return self.transactions_of(self.raw("orders"))

    @staticmethod
    def transactions_of(orders: DataFrame) -> DataFrame:
        status = F.col("o_orderstatus")

        def by_status(f: str, o: str, other: str) -> Column:
            return F.when(status == "F", f).when(status == "O", o).otherwise(other)

        return orders.select(
            _text("txn-", _pad("o_orderkey", 12)).alias("transaction_id"),
            F.col("o_custkey").alias("customer_id"),
            _text("ACC-", _pad("o_custkey", 9)).alias("account_number"),
            _pad(F.col("o_custkey") % 1000, 9).alias("routing_number"),
            _pad(F.col("o_orderkey") % 10000, 4).alias("card_last_four"),
            _money(F.col("o_totalprice")).alias("transaction_amount"),
            by_status("Purchase", "Transfer", "Subscription").alias("transaction_type"),
            _text("Merchant ", _str(F.col("o_custkey") % 100)).alias("merchant_name"),
            F.col("o_orderpriority").alias("merchant_category"),
            F.col("o_orderdate").alias("transaction_date"),
            F.lit("USD").alias("currency"),
            by_status("Completed", "Pending", "Declined").alias("status"),
            ((F.col("o_orderpriority") == "1-URGENT") & (status == "P")).alias("fraud_flag"),
            _ip("10.0.", "o_custkey").alias("ip_address"),
            _text("fp-", _str("o_custkey")).alias("device_fingerprint"))

    @cached_property
    def employees(self) -> DataFrame:
        k = F.col("s_suppkey")
        df = self.raw("supplier").join(self.places, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        salary = _money(F.abs("s_acctbal"))
        return df.select(
            k.alias("employee_id"),
            _text("EMP-", _pad(k, 9)).alias("employee_number"),
            F.split_part("s_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("s_name", F.lit("#"), F.lit(2)).alias("last_name"),
            _text(F.lower(F.replace("s_name", F.lit("#"), F.lit("."))), "@company.example").alias("email"),
            F.when(k % 6 != 5, _text("home", _str(k), "@mail.example")).alias("personal_email"),
            _text("555-", _pad(k % 10000, 4)).alias("phone"),
            _ssn("s_suppkey").alias("ssn"),
            _day("1960-01-01", k % 15000).alias("date_of_birth"),
            _day("2010-01-01", k % 3000).alias("hire_date"),
            F.when(k % 10 == 7, F.lit("2024-06-30").cast("date")).alias("termination_date"),
            F.col("n_name").alias("department"),
            _text("Grade ", _str(k % 5)).alias("job_title"),
            F.when(k % 25 == 24, F.lit(-1)).when(k != 0, F.floor((k - 1) / 4))
             .cast("long").alias("manager_id"),
            salary.alias("salary"),
            _money(F.round(salary * F.lit("0.1").cast("decimal(3,1)"), 2)).alias("bonus"),
            _text("BANK-", _pad(k, 9)).alias("bank_account"),
            _text("Rating ", _str(k % 4)).alias("performance_rating"),
            F.col("r_name").alias("location_office"),
            (k % 4 == 0).alias("remote_work"),
            _text("Level ", _str(k % 5 + 1)).alias("clearance_level"))

    @cached_property
    def products(self) -> DataFrame:
        k = F.col("p_partkey")
        price = _money(F.col("p_retailprice"), 10)
        return self.raw("part").select(
            k.alias("product_id"),
            _text("SKU-", _pad(k, 9)).alias("product_sku"),
            F.col("p_name").alias("product_name"),
            _text("A ", F.col("p_name"), " by ", F.col("p_brand")).alias("product_description"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"),
            price.alias("unit_price"),
            _money(F.round(price * F.lit("0.6").cast("decimal(3,1)"), 2), 10).alias("cost_price"),
            F.lit("40.00").cast("decimal(5,2)").alias("profit_margin"),
            (F.col("p_size") * 10).cast("long").alias("stock_quantity"),
            F.col("p_size").cast("long").alias("reorder_threshold"),
            _text("SUP-", _pad(k % 1000, 3)).alias("supplier_id"),
            (F.col("p_size") % 10 != 0).alias("is_active"),
            _day("2020-01-01", k % 1000).alias("launch_date"),
            F.lit("2024-01-01").cast("timestamp_ntz").alias("last_modified"))

    @cached_property
    def audit_logs(self) -> DataFrame:
        return self.audit_logs_of(self.raw("events"))

    @staticmethod
    def audit_logs_of(events: DataFrame) -> DataFrame:
        k, u = F.col("event_id"), F.col("user_id")
        failed = F.col("event_type") == "error"
        tier = (F.when(k % 4 == 0, "Restricted").when(k % 4 == 1, "PII")
                .when(k % 4 == 2, "Internal").otherwise("Public"))
        return events.select(
            _text("log-", _pad(k, 12)).alias("log_id"),
            F.col("ts").alias("event_timestamp"),
            _text("user:", _str(u)).alias("user_id"),
            F.when(u % 10 != 0, _text("user", _str(u), "@company.example")).alias("user_email"),
            _ip("10.1.", "user_id").alias("source_ip"),
            F.col("event_type").alias("action_type"),
            _text("table_", _str(k % 50), ".*").alias("resource_accessed"),
            tier.alias("data_classification"),
            (~failed).alias("success_flag"),
            F.when(failed, "Insufficient permissions").alias("failure_reason"),
            _text("sess-", _str(u), "-", _str(k % 1000)).alias("session_id"),
            F.lit("Agent/1.0").alias("user_agent"),
            (k % 1000).alias("records_accessed"),
            _text("qh-", _pad(k % 100000, 5)).alias("query_hash"))

    def table(self, name: str) -> DataFrame:
        return {
            "CUSTOMERS": lambda: self.customers, "EMPLOYEES": lambda: self.employees,
            "PRODUCTS": lambda: self.products, "FINANCIAL_TRANSACTIONS": lambda: self.transactions,
            "AUDIT_LOGS": lambda: self.audit_logs,
        }[name.upper()]()

    def all(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in LABEL_OF}


def minimise(df: DataFrame, table: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """The data-minimising projection of an entity: its safe subset of columns.

    The employee's active flag and the audit record's renamed tier are derived
    first.  A column the source lacks takes its default, else NULL; a NULL boolean
    becomes false. ``extra`` columns are kept as they are.
    """
    name = table.upper()
    if name == "EMPLOYEES" and "termination_date" in df.columns:
        df = df.withColumn("is_active", F.col("termination_date").isNull())
    if name == "AUDIT_LOGS":
        df = df.withColumnRenamed("data_classification", "data_classification_accessed")
    have = dict(df.dtypes)

    def kept(column: str) -> Column:
        if column not in have:
            value = ABSENT_DEFAULTS.get(column)
            return (F.lit(None).cast("string") if value is None else F.lit(value)).alias(column)
        return or_false(column).alias(column) if have[column] == "boolean" else F.col(column)

    return df.select([kept(c) for c in KEPT_COLUMNS[name]] + [F.col(c) for c in extra])


def with_provenance(df: DataFrame, table: str, platform: str, run_ts) -> DataFrame:
    """Source table, platform and one load time for the whole run."""
    return df.withColumns({
        "source_table": F.lit(table.upper()),
        "source_platform": F.lit(platform),
        "ingested_at": F.lit(run_ts)})


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns to the model's types; values that do not parse become NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})
