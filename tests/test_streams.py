"""Streams give what the batch operators give, however the input is cut into batches."""

import pytest
from pyspark.sql import functions as F

from tierwarden.model import local_df
from tierwarden.operators import catalog as C
from tierwarden.operators.secure import secure
from tierwarden.operators.sync import CatalogStore, DriftStore
from tierwarden.streaming import streams as W

DDL = "table_name string, column_name string, tag_name string, tag_value string, seq int"
FIRST = [("T", "a", "data_classification", "PII", 2), ("T", "b", "data_owner", "X", 1)]
SECOND = [("T", "a", "data_classification", "Public", 1),   # arrives late, was assigned earlier
          ("T", "a", "data_owner", "Y", 3), ("T", "b", "data_owner", "Z", 4)]


@pytest.fixture()
def folder(spark, tmp_path):
    path = str(tmp_path / "in")
    for part in (FIRST, SECOND):
        spark.createDataFrame(part, DDL).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, folder):
    schema = spark.read.parquet(folder).schema
    return W.read_files(spark, folder, schema, files_per_batch=1)


def test_drift_stream(spark, folder, tmp_path):
    out = str(tmp_path / "drift")
    for _ in range(2):  # a restart finds nothing new
        W.stream_detect_changes(stream(spark, folder), out, ["seq"]).awaitTermination()
    store = DriftStore(spark, out)
    batch = C.current_tags(spark.createDataFrame(FIRST + SECOND, DDL), ["seq"])
    snap = store.snapshot.read().select(batch.columns)
    assert snap.exceptAll(batch).count() == 0 and batch.exceptAll(snap).count() == 0
    assert snap.where("column_name = 'a'").first().data_classification == "PII"
    log = store.log.read()
    assert log.select("change_id").distinct().count() == log.count()
    last = {(r.column_name, r.tag_field): r.new_value for r in log.orderBy("changed_at").collect()}
    assert last[("b", "DATA_OWNER")] == "Z"


def test_sync_stream(spark, folder, tmp_path):
    out = str(tmp_path / "sync")
    inventory = local_df(spark, [("T", "a", "TEXT", "YES", 1), ("T", "b", "TEXT", "YES", 2)],
                         "table_name string, column_name string, data_type string, is_nullable string, "
                         "ordinal_position int")
    W.stream_tag_sync(stream(spark, folder), out, ["seq"], inventory).awaitTermination()
    store = CatalogStore(spark, out)
    found = {r.column_name: (r.data_classification, r.data_owner) for r in store.catalog.read().collect()}
    assert found == {"a": ("PII", "Y"), "b": ("Unclassified", "Z")}
    assert store.edges.read().where("type = 'CLASSIFIED_AS'").count() == 1
    assert store.runs().count() >= 1


def test_secured_stream(spark, fixture, tmp_path):
    table = fixture.entities["FINANCIAL_TRANSACTIONS"]
    table.repartition(3).write.parquet(str(tmp_path / "in"))
    rows = W.read_files(spark, str(tmp_path / "in"), table.schema)
    W.stream_secure(rows, "FINANCIAL_TRANSACTIONS", "DATA_ANALYST", str(tmp_path / "out"),
                    str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select(table.columns)
    want = secure(table, "FINANCIAL_TRANSACTIONS", "DATA_ANALYST")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.where(F.col("fraud_flag")).count() == 0
