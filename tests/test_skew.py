"""Paths against brute force, and keys that hold much of the data."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierwarden.operators import paths as P
from tierwarden.operators import graph as G


def brute(nodes, edges, max_hops):
    """Every walk from a node to a root using no edge twice."""
    out = {}
    for e in edges:
        out.setdefault(e[0], []).append(e)
    found = []

    def walk(path, used):
        here = path[-1]
        if here not in out:
            found.append((path[0], tuple(path)))
            return
        if len(path) - 1 < max_hops:
            for e in out[here]:
                if e not in used:
                    walk(path + [e[1]], used | {e})
    for n in nodes:
        walk([n], frozenset())
    return sorted(found)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.tuples(st.integers(0, 7), st.integers(0, 7)), min_size=1, max_size=10), st.integers(1, 3))
def test_paths_to_root_equal_brute_force(spark, edges, hops):
    nodes = list(range(8))
    got = P.paths_to_root(spark.createDataFrame([(n,) for n in nodes], "id long"),
                          spark.createDataFrame(sorted(edges), "src long, dst long"), hops)
    assert sorted((r.start, tuple(r.path)) for r in got.collect()) == brute(nodes, edges, hops)


def test_descend_ends_on_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "src string, dst string")
    top = spark.createDataFrame([("a",)], "id string")
    found = {tuple(r.path) for r in P.descend(edges, top).collect()}
    assert found == {("a", "b"), ("a", "b", "a"), ("a", "b", "c")}


def test_flat_tree_with_one_hot_parent(spark):
    edges = spark.range(1, 2001).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    assert P.descend(edges, spark.range(1)).count() == 2000


def test_a_customer_with_a_third_of_all_transactions(spark):
    made = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).cast("long").alias("customer_id"),
                                     F.col("id").alias("transaction_id"))
    known = spark.range(1, 400).select(F.col("id").alias("customer_id"))
    want = made.where("customer_id between 1 and 399").count()
    edges = G.made_transaction(made, known)
    assert edges.count() == want and edges.where("src = 'Customer:1'").count() > 10000
    # the transactions are read once: nothing is counted beforehand
    assert edges._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 30000") == 1
