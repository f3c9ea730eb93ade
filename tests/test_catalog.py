from datetime import datetime

from pyspark.sql import functions as F

from tierwarden.functions.text import column_fqn, or_default, strip
from tierwarden.model import (
    RANKS, TAG_FIELDS, policy_refs_df, sheet_assignments, taxonomy_df,
)
from tierwarden.operators import catalog as C
from tierwarden.operators.graph import sheet_tiers, table_tier
from tierwarden.sources import inventory as I
from tierwarden.sources.entities import coerce, minimise, with_provenance


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_tag_references(fixture):
    assert fixture.refs.count() == 108
    per_tag = dict(rows(fixture.refs.groupBy("tag_name").count()))
    assert per_tag == {"DATA_CLASSIFICATION": 81, "ENCRYPTION_REQUIRED": 7, "DATA_OWNER": 9,
                       "RETENTION_POLICY": 6, "DATA_CATEGORY": 5}
    assert I.short_refs(fixture.sheet, "CUSTOMERS").select("column_name").distinct().count() == 16


def test_catalog_shape(fixture):
    assert fixture.catalog.count() == 81
    assert dict(rows(C.columns_per_table(fixture.catalog))) == {
        "CUSTOMERS": 16, "EMPLOYEES": 21, "FINANCIAL_TRANSACTIONS": 15, "PRODUCTS": 15, "AUDIT_LOGS": 14}
    assert dict(rows(C.tier_coverage(fixture.catalog))) == {"Internal": 39, "Restricted": 18, "PII": 14, "Public": 10}


def test_defaults_and_strip(spark):
    df = spark.createDataFrame([(None,), ("",), ("  \tx \n",)], "v string")
    assert [r[0] for r in df.select(or_default("v", "No")).collect()] == ["No", "No", "  \tx \n"]
    assert [r[0] for r in df.select(strip("v")).collect()] == [None, "", "x"]
    assert spark.range(1).select(column_fqn(F.lit(None).cast("string"), F.lit("c"))).first()[0] is None


def test_last_assignment_wins(spark):
    df = spark.createDataFrame(
        [("T", "c", "tag", 1, "a"), ("T", "c", "tag", 3, "b"), ("T", "c", "tag", 2, "z"), ("T", "d", "tag", 1, "q")],
        "table_name string, column_name string, tag_name string, seq int, tag_value string")
    assert sorted(rows(C.assign_tags(df, ["seq"]))) == [("T", "c", "tag", "b"), ("T", "d", "tag", "q")]


def test_one_pass_equals_two_passes(spark):
    data = [(f"T{i % 3}", f"c{i % 5}", TAG_FIELDS[i % 5], i * 7 % 31, None if i % 4 == 0 else f"v{i}")
            for i in range(200)]
    df = spark.createDataFrame(data, "table_name string, column_name string, tag_name string, seq int, tag_value string")
    once = C.current_tags(df, ["seq"])
    twice = C.pivot_tags(C.assign_tags(df, ["seq"]))
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_normalise_case(spark):
    df = spark.createDataFrame([("t", "c", "data_owner", "X")],
                               "table_name string, column_name string, tag_name string, tag_value string")
    assert rows(C.normalise_refs(df)) == [("T", "C", "DATA_OWNER", "X")]


def test_validate(spark, fixture):
    assert C.validate_tags(fixture.refs, taxonomy_df(spark)).count() == 0
    bad = spark.createDataFrame(
        [("T", "c", "DATA_CLASSIFICATION", "Secret"), ("T", "c", "COLOUR", "red"), ("T", "c", "DATA_OWNER", "any")],
        "table_name string, column_name string, tag_name string, tag_value string")
    found = {(r.tag_name, r.violation) for r in C.validate_tags(bad, taxonomy_df(spark)).collect()}
    assert found == {("DATA_CLASSIFICATION", "VALUE NOT ALLOWED"), ("COLOUR", "UNKNOWN TAG")}


def test_rollup(fixture):
    plain = {r.table_name: r.data_classification for r in C.rollup_classification(fixture.catalog, {}).collect()}
    assert set(plain.values()) == {"Restricted"}
    default = {r.table_name: r.data_classification for r in C.rollup_classification(fixture.catalog).collect()}
    assert default["AUDIT_LOGS"] == "Internal" and default["CUSTOMERS"] == "Restricted"
    assert table_tier("AUDIT_LOGS", sheet_tiers("AUDIT_LOGS")) == "Internal"


def test_row_tier_is_no_less_sensitive_than_any_value(spark):
    df = spark.createDataFrame([("s", "e", 1), (None, "e", 1), (None, None, 1), (None, None, None)],
                               "ssn string, email string, n int")
    tier = C.record_tier(df, {"ssn": "Restricted", "email": "PII", "n": "Internal"})
    assert [r[0] for r in df.select(tier).collect()] == ["Restricted", "PII", "Internal", None]
    assert list(RANKS) == ["Restricted", "PII", "Internal", "Public"]


def test_governed_tables(spark, fixture):
    found = sorted(r[0] for r in C.discover_governed_tables(fixture.sheet, fixture.policy_refs).collect())
    assert found == ["AUDIT_LOGS", "CUSTOMERS", "EMPLOYEES", "FINANCIAL_TRANSACTIONS", "PRODUCTS"]
    none = C.discover_governed_tables(fixture.sheet.limit(0), fixture.policy_refs.limit(0))
    assert none.count() == 0 and none.columns == ["table_name"]


def test_insert_defaults(spark):
    ts = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, None, None, None), (2, "UK", ts, False)],
                               "customer_id long, country string, created_at timestamp_ntz, is_active boolean")
    out = C.apply_defaults(df, "CUSTOMERS", datetime(2025, 5, 5)).orderBy("customer_id")
    assert rows(out) == [(1, "USA", datetime(2025, 5, 5), True), (2, "UK", ts, False)]


def test_key_and_null_checks(spark, fixture):
    assert rows(C.check_unique(fixture.entities["FINANCIAL_TRANSACTIONS"], "customer_id").orderBy("key_value")) == [
        ("1001", 2), ("1003", 2)]
    assert C.check_unique(fixture.entities["CUSTOMERS"], "customer_id").count() == 0
    assert C.check_not_null(fixture.entities["CUSTOMERS"], "CUSTOMERS").count() == 0
    found = rows(C.check_not_null(fixture.entities["AUDIT_LOGS"], "AUDIT_LOGS", ["log_id", "user_email"]))
    assert found == [("AUDIT_LOGS", "user_email", 2)]


def test_minimised_columns(fixture):
    e = fixture.entities
    assert "ssn" not in minimise(e["EMPLOYEES"], "EMPLOYEES").columns
    assert minimise(e["EMPLOYEES"], "EMPLOYEES").where(~F.col("is_active")).count() == 1
    assert "data_classification_accessed" in minimise(e["AUDIT_LOGS"], "AUDIT_LOGS").columns
    narrow = e["CUSTOMERS"].select("customer_id", F.lit(None).cast("boolean").alias("is_active"))
    row = minimise(narrow, "CUSTOMERS").first()
    assert row.is_active is False and row.city is None and row.country == "USA"
    assert minimise(e["CUSTOMERS"].select("customer_id"), "CUSTOMERS").first().is_active is True
    out = with_provenance(minimise(e["PRODUCTS"], "PRODUCTS"), "products", "warehouse", datetime(2024, 1, 1))
    assert out.select("source_table", "ingested_at").distinct().count() == 1


def test_coerce_makes_bad_values_null(spark):
    df = spark.createDataFrame([("1",), ("x",)], "k string")
    assert [r[0] for r in coerce(df, {"k": "long"}).collect()] == [1, None]


def test_sources(spark, fixture, tmp_path):
    path = str(tmp_path / "p")
    fixture.entities["PRODUCTS"].repartition(3).write.parquet(path)
    assert I.read_entity(spark, path).count() == 10
    row = I.table_inventory(spark, {"PRODUCTS": path}).first()
    assert row.table_name == "PRODUCTS" and row.row_count == 10 and row.bytes > 0 and row.created is not None
    assert policy_refs_df(spark, ["customers"]).count() == 3
    empty = policy_refs_df(spark, ["nowhere"])
    assert empty.count() == 0 and "policy_kind" in empty.columns
    assert policy_refs_df(spark).count() == 15
    held = {r.object for r in I.grants_for(spark, "DATA_ANALYST").collect()}
    assert "ROLE PUBLIC_USER" in held and len(held) == 6
    assert I.list_policies(spark, "ROW_ACCESS").count() == 3
    assert I.list_policies(spark, name="ssn_masking_policy").count() == 1
    assert I.list_tags(spark).count() == 5
    assert fixture.inventory.count() == 81
    assert len(sheet_assignments()) == 108


def test_declared_lengths_are_in_the_inventory(spark):
    from pyspark.sql import types as T
    frame = spark.createDataFrame([("a", "b", "c")], T.StructType([
        T.StructField("code", T.StringType(), True, {"__CHAR_VARCHAR_TYPE_STRING": "char(3)"}),
        T.StructField("name", T.StringType(), True, {"__CHAR_VARCHAR_TYPE_STRING": "varchar(120)"}), T.StructField("free", T.StringType())]))
    from tierwarden.sources.inventory import catalog_from_schemas
    got = {r.column_name: r.character_maximum_length for r in catalog_from_schemas(spark, {"t": frame}).collect()}
    assert got == {"CODE": 3, "NAME": 120, "FREE": None}
