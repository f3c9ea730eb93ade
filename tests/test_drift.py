from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierwarden.model import CATALOG_SCHEMA, TAG_FIELDS, TAG_SNAPSHOT_SCHEMA, local_df
from tierwarden.operators import catalog as C
from tierwarden.operators import drift as D
from pyspark.sql import types as T

from tierwarden.operators import sync
from tierwarden.operators.sync import CatalogStore, DriftStore, record_drift, sync_tags
from tierwarden.sources.merged import Keyed, MergedTable

QUIET = {"data_classification": "Unclassified", "encryption_required": "No"}
T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
WIDE = "fqn string, " + ", ".join(f"{f} string" for f in TAG_FIELDS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def wide(spark, *data):
    return local_df(spark, [(k, *v) for k, v in data], WIDE)


def test_diff_cases(spark):
    stored = wide(spark,
                  ("changed", ("PII", "", "No", "", "")), ("lost_one", ("PII", "Personal", "No", "", "")),
                  ("space", ("PII", "", "Yes", "", "")), ("unclassified", ("Unclassified", "", "No", "", "")),
                  ("deleted", ("PII", "", "No", "", "")))
    source = wide(spark,
                  ("changed", ("Restricted", None, None, None, None)), ("lost_one", ("PII", None, "No", None, None)),
                  ("space", (" PII\t", None, "Yes", None, None)), ("unclassified", (None, None, None, None, None)),
                  ("brand_new", (None, None, None, None, None)))
    plain = rows(D.diff_tags(source, stored))
    assert plain == rows(local_df(spark, [
        ("brand_new", "new", None, None, None),
        ("changed", "changed", "data_classification", "PII", "Restricted"),
        ("changed", "changed", "encryption_required", "No", "(none)"),
        ("lost_one", "changed", "data_category", "Personal", "(none)"),
        ("space", "unchanged", None, None, None),
        ("unclassified", "changed", "encryption_required", "No", "(none)")],
        "fqn string, status string, field string, old_value string, new_value string"))
    quiet = {(r.fqn, r.status, r.field) for r in D.diff_tags(source, stored, empty_equivalents=QUIET,
                                                             include_removed=True).collect()}
    assert quiet == {("brand_new", "new", None), ("changed", "changed", "data_classification"),
                     ("lost_one", "changed", "data_category"), ("space", "unchanged", None),
                     ("unclassified", "unchanged", None), ("deleted", "removed", None)}


def test_first_and_second_drift_run(spark, fixture, tmp_path):
    store = DriftStore(spark, str(tmp_path))
    tags = C.pivot_tags(fixture.refs)
    assert record_drift(tags, store, T1) == 108
    assert store.snapshot.read().count() == 81
    assert record_drift(tags, store, T2) == 0
    assert store.log.read().count() == 108 and store.snapshot.read().count() == 81
    assert store.snapshot.read().select("captured_at").distinct().count() == 1
    assert D.change_message(108) == "OK: 108 tag changes logged."


def test_repeated_version_replaces_itself(spark, fixture, tmp_path):
    store = DriftStore(spark, str(tmp_path))
    tags = C.pivot_tags(fixture.refs)
    for _ in range(2):
        assert record_drift(tags, store, T1, version=0) == 108
    assert store.log.read().count() == 108
    changed = tags.withColumn("data_owner", F.when(F.col("column_name") == "SSN", "New Team")
                              .otherwise(F.col("data_owner")))
    for _ in range(2):
        assert record_drift(changed, store, T2, version=1) == 2
    assert store.log.read().count() == 110


def test_drift_cases(spark):
    def snap(*data):
        return local_df(spark, [(1, "T", k, *v, T1) for k, v in data], TAG_SNAPSHOT_SCHEMA)

    def now(*data):
        return local_df(spark, [("T", k, *v) for k, v in data],
                        "table_name string, column_name string, " + WIDE.replace("fqn string, ", ""))

    none = (None,) * 4
    before = snap(("a", ("PII", *none)), ("b", ("", *none)), ("gone", ("PII", *none)))
    current = now(("a", ("Public", *none)), ("b", (None, *none)), ("new_untagged", (None, *none)),
                  ("new_tagged", ("PII", "Personal", None, None, None)))
    log = D.detect_tag_changes(current, before, T2)
    assert rows(log.select("column_name", "tag_field", "old_value", "new_value")) == [
        ("a", "DATA_CLASSIFICATION", "PII", "Public"), ("new_tagged", "DATA_CATEGORY", None, "Personal"),
        ("new_tagged", "DATA_CLASSIFICATION", None, "PII")]
    after = D.merge_snapshot(before, current, T2)
    found = {r.column_name: (r.data_classification, r.captured_at) for r in after.collect()}
    assert found["gone"] == ("PII", T1) and found["a"] == ("Public", T2) and len(found) == 5
    assert D.detect_tag_changes(current, after, T3).count() == 0


def test_log_queries(spark, fixture):
    empty = local_df(spark, [], TAG_SNAPSHOT_SCHEMA)
    tags = C.pivot_tags(fixture.refs)
    log = D.detect_tag_changes(tags, empty, T1)
    assert D.pending_changes(log).count() == 108
    done = D.mark_synced(log, T2)
    assert D.pending_changes(done).count() == 0 and done.where(F.col("synced_at").isNull()).count() == 0
    assert [r.tag_field for r in D.column_history(log, "EMPLOYEES", "SALARY").collect()] == [
        "DATA_CLASSIFICATION", "DATA_OWNER", "ENCRYPTION_REQUIRED", "RETENTION_POLICY"]
    assert log.select("change_id").distinct().count() == 108


@pytest.fixture()
def loaded(spark, fixture, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "store"))
    first = sync_tags(fixture.raw_catalog, store, run_ts=T1)
    return store, first


def test_load_then_sync(fixture, loaded):
    store, first = loaded
    assert (first.new, first.changed, first.written, first.catalog_columns) == (81, 0, 81, 0)
    dry = sync_tags(fixture.raw_catalog, store, dry_run=True, run_ts=T2)
    assert (dry.new, dry.changed, dry.unchanged, dry.written) == (0, 74, 7, 0)
    assert store.catalog.version() == 0
    # Untagged encryption flags are reported on every run, and every column is rewritten.
    again = sync_tags(fixture.raw_catalog, store, run_ts=T2)
    assert (again.changed, again.written) == (74, 81)
    assert {r.sync_version for r in store.catalog.read().collect()} == {2}
    assert sync_tags(fixture.raw_catalog, store, dry_run=True, run_ts=T3).changed == 74


def test_quiet_sync_writes_nothing(fixture, loaded):
    store, _ = loaded
    out = sync_tags(fixture.raw_catalog, store, empty_equivalents=QUIET, run_ts=T2)
    assert (out.new, out.changed, out.unchanged, out.written) == (0, 0, 81, 0)
    assert store.catalog.version() == 0 and store.runs().count() == 1


def test_changed_only(fixture, loaded):
    store, _ = loaded
    changed = fixture.raw_catalog.withColumn(
        "data_classification", F.when(F.col("column_name") == "COUNTRY", "Internal").otherwise(F.col("data_classification")))
    out = sync_tags(changed, store, changed_only=True, empty_equivalents=QUIET, run_ts=T2)
    assert (out.changed, out.written) == (1, 1)
    stored = {r.fqn: r for r in store.catalog.read().collect()}
    assert len(stored) == 81 and sorted(r.sync_version for r in stored.values())[-2:] == [1, 2]
    edges = {(r.src, r.dst) for r in store.edges.read().where("type = 'CLASSIFIED_AS'").collect()}
    country = "Column:SECURITY_DEMO_DB.DEMO_SCHEMA.CUSTOMERS.COUNTRY"
    assert (country, "Classification:Internal") in edges and len(edges) == 81
    assert (country, "Classification:Public") not in edges


def test_no_governed_table(spark, loaded):
    store, _ = loaded
    out = sync_tags(local_df(spark, [], CATALOG_SCHEMA), store, run_ts=T2)
    assert (out.source_columns, out.new, out.changed, out.written) == (0, 0, 0, 0)
    assert store.catalog.read().count() == 81


def test_sync_runs_are_listed(fixture, loaded):
    store, _ = loaded
    sync_tags(fixture.raw_catalog, store, run_ts=T2)
    assert [r.written for r in store.runs().orderBy("sync_ts").collect()] == [81, 81]


def test_sync_stores_the_chain(loaded):
    store, _ = loaded
    counts = dict(store.edges.read().groupBy("type").count().collect())
    assert counts == {"CONTAINS_SCHEMA": 1, "CONTAINS_TABLE": 5, "HAS_COLUMN": 81, "CLASSIFIED_AS": 81}
    assert dict(store.vertices.read().groupBy(F.col("labels")[0]).count().collect()) == {"Database": 1, "Schema": 1, "Table": 5}


def test_a_crash_publishes_nothing_and_the_next_run_writes_all(spark, fixture, tmp_path, monkeypatch):
    store = CatalogStore(spark, str(tmp_path / "store"))

    def crash(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as broken:
        broken.setattr(sync, "classified_as", crash)
        with pytest.raises(RuntimeError):
            sync_tags(fixture.raw_catalog, store, run_ts=T1)
    assert store.catalog.version() is None and store.catalog.read().count() == 0 and store.runs().count() == 0
    again = sync_tags(fixture.raw_catalog, store, run_ts=T1)
    assert again.written == 81 and store.edges.read().count() == 168 and store.runs().count() == 1


def test_two_writers_of_one_version(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), Keyed(T.StructType([T.StructField("x", T.LongType())]), ("x",)))
    table.upsert(spark.range(3).toDF("x"))
    table.store._newest = lambda before=None: None      # a second writer that saw no commit yet
    with pytest.raises(Exception):
        table.upsert(spark.range(5).toDF("x"))
    del table.store._newest
    assert table.read().count() == 3
    table.upsert(spark.range(4).toDF("x"), 0)           # a replay names its version
    assert table.read().count() == 4


def test_dry_run_writes_nowhere(spark, fixture, tmp_path, monkeypatch):
    store = CatalogStore(spark, str(tmp_path / "store"))
    monkeypatch.setattr(sync, "write_through", None)
    assert sync_tags(fixture.raw_catalog, store, dry_run=True, run_ts=T1).new == 81
    assert not (tmp_path / "store").exists()


def test_intervals_and_catalog_at(spark):
    from datetime import datetime as at
    day = [at(2024, 1, d) for d in range(1, 9)]
    rows = [("T", "a", "DATA_OWNER", "x", day[1], 1), ("T", "a", "DATA_OWNER", "y", day[1], 2), ("T", "a", "DATA_OWNER", "y", day[2], 3),
            ("T", "a", "DATA_OWNER", None, day[3], 4), ("T", "a", "DATA_OWNER", "y", day[5], 5), ("T", "a", "DATA_CATEGORY", "p", day[4], 6),
            ("T", "b", "DATA_OWNER", None, day[2], 7)]
    statements = local_df(spark, rows, "table_name string, column_name string, tag_field string, value string, time timestamp, n int")
    found = D.tag_intervals(statements, ["time", "n"])
    assert {(r.column_name, r.tag_field, r.value, r.valid_from.day, r.valid_to and r.valid_to.day) for r in found.collect()} == {
        ("a", "DATA_OWNER", "y", 2, 4), ("a", "DATA_OWNER", None, 4, 6), ("a", "DATA_OWNER", "y", 6, None),
        ("a", "DATA_CATEGORY", "p", 5, None), ("b", "DATA_OWNER", None, 3, None)}
    moments = local_df(spark, [("T", c, d) for c in "abc" for d in day], "table_name string, column_name string, moment timestamp")
    got = {(r.column_name, r.moment.day): (r.data_owner, r.data_category) for r in D.catalog_at(found, moments.union(moments)).collect()}
    want = {}
    for c in "abc":
        for d in day:
            last = {}
            for _, column, field, value, time, _ in sorted(rows, key=lambda r: (r[4], r[5])):
                if column == c and time <= d:
                    last[field] = value
            want[c, d.day] = (last.get("DATA_OWNER"), last.get("DATA_CATEGORY"))
    assert got == want
    log = D.detect_tag_changes(local_df(spark, [("T", "a", "PII", None, None, None, None)], "table_name string, column_name string, "
                               + WIDE.replace("fqn string, ", "")), local_df(spark, [], TAG_SNAPSHOT_SCHEMA), T1)
    assert [(r.tag_field, r.value, r.valid_to) for r in D.log_intervals(log).collect()] == [("DATA_CLASSIFICATION", "PII", None)]


def test_both_states_in_one_pass(spark):
    rows = [("T", "a", "data_owner", "x", 1), ("T", "a", "data_owner", "y", 5), ("T", "b", "data_owner", "z", 6), ("T", "c", "data_category", None, 2)]
    statements = spark.createDataFrame(rows, "table_name string, column_name string, tag_name string, tag_value string, seq int")
    both = C.tags_before(statements, ["seq"], F.col("seq") < 5)
    now, was = C.current_tags(statements, ["seq"]), C.current_tags(statements.where("seq < 5"), ["seq"])
    assert rows_of(both.select(now.columns)) == rows_of(now)
    assert rows_of(both.where("known").select(*C.KEY, *[F.col(f"was_{f}").alias(f) for f in now.columns[2:]])) == rows_of(was)


def rows_of(df):
    return sorted(map(str, df.collect()))
