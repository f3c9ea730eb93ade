"""The merge-on-read store against a plain dict, and what it writes."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwarden.sources.merged import Keyed, MergedStore, MergedTable

ROWS = Keyed(T.StructType([T.StructField("k", T.LongType()), T.StructField("part", T.StringType()), T.StructField("v", T.StringType())]), ("k", "part"))


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("merge", [True, False])
def test_upserts_and_removals(spark, tmp_path, merge):
    table = MergedTable(spark, str(tmp_path / "t"), ROWS)
    assert table.read().count() == 0 and table.version() is None
    rng, want = random.Random(1), {}
    for batch in range(8):
        change = {(rng.choice([None, *range(30)]), rng.choice([None, "a", "b"])): (f"{batch}", rng.random() < 0.3) for _ in range(rng.choice([1, 5, 40]))}
        rows = spark.createDataFrame([(*k, *x) for k, x in change.items()], "k long, part string, v string, _gone boolean")
        assert table.upsert(rows, merge=merge) == batch
        for k, (v, gone) in change.items():
            want.pop(k, None)
            if not gone:
                want[k] = v
        assert {(r.k, r.part): r.v for r in table.read().collect()} == want
        near = spark.createDataFrame([(3, "a"), (None, None)], "k long, part string")
        found = {(r.k, r.part): r.v for r in table.read(near=near).collect()}
        assert found.items() <= want.items() and all(found.get(k) == want.get(k) for k in [(3, "a"), (None, None)])
    assert table.read(near=near.limit(0)).count() == 0
    assert {(r.k, r.part): r.v for r in table.read(before=8).collect()} == want


def test_a_batch_writes_its_own_rows(spark, tmp_path):
    """Twenty small batches on a large base: the base's files stay, parts stay few, written rows follow the batch."""
    path = str(tmp_path / "t")
    table = MergedTable(spark, path, ROWS, MergedStore(spark, path, {"rows": ROWS}, keep=3))
    table.upsert(spark.range(20000).select(F.col("id").alias("k"), F.lit("x").alias("part"), F.lit("base").alias("v")))
    base = files(path)
    assert len(base) <= 8
    written = 0
    for batch in range(20):
        rows = spark.range(100).select((F.col("id") * 150 + batch * 7).alias("k"), F.lit("x").alias("part"), F.lit(f"b{batch}").alias("v"))
        table.upsert(rows)
        parts = table.store._newest()["parts"]["rows"]
        assert len(parts) <= 7 and parts[0]["rows"] == 20000
        written += sum(p["rows"] for p in parts if p["folder"].startswith(f"{batch + 1}-"))
    assert base <= files(path)
    assert written < 20 * 100 * 6 < 20000
    assert len(os.listdir(f"{path}/commits")) - sum(x.startswith((".", "_")) for x in os.listdir(f"{path}/commits")) == 3
    assert len({f.split("/rows/")[1].split("/")[0] for f in files(path)}) <= 3 * 6
    got = {r.v: r.n for r in table.read().groupBy("v").agg(F.count("*").alias("n")).collect()}
    want = {}
    for batch in range(20):
        want |= {i * 150 + batch * 7: f"b{batch}" for i in range(100)}
    assert sum(got.values()) == 20000 and got["base"] == 20000 - len(want)
    assert all(got.get(f"b{b}", 0) == sum(v == f"b{b}" for v in want.values()) for b in range(20))


def test_only_touched_buckets_are_opened(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), ROWS)
    table.upsert(spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("part"), F.lit("base").alias("v")))
    near = spark.createDataFrame([(7, "x")], "k long, part string")
    opened = table.read(near=near).select(F.input_file_name()).distinct().count()
    assert opened == 1 and table.read(near=near).where("k = 7").count() == 1
    assert table.read().select(F.input_file_name()).distinct().count() == 8


def test_tables_of_a_store_are_published_together(spark, tmp_path):
    store = MergedStore(spark, str(tmp_path / "s"), {"a": ROWS, "b": ROWS})
    row = spark.createDataFrame([(1, "x", "1")], ROWS.schema)

    def lost():
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        store.commit({"a": row, "b": lost})
    assert store.version() is None and store.read("a").count() == 0
    store.commit({"a": row}, totals={"a": 1})
    store.commit({"b": row.withColumn("v", F.lit("2"))})
    assert (store.total("a"), store.total("b"), store.read("a").first().v, store.read("b", before=1).count()) == (1, 1, "1", 0)
    store.commit({"a": row.withColumn("v", F.lit("3"))}, version=1)      # a replay starts from what was before it
    assert (store.read("a").first().v, store.read("b").count()) == ("3", 0)
