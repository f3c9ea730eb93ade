"""Where working copies may go."""

from types import SimpleNamespace

import pytest

from tierwarden.operators.durable import cut_lineage, scratch_path, shared_dir, write_through


def session(master, conf=None, directory=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: (conf or {}).get(k, d)),
                           sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: directory))


def test_named_folder_is_used():
    assert shared_dir(session("yarn", {"spark.checkpoint.dir": "/shared/cp"})) == "/shared/cp"
    assert shared_dir(session("yarn", directory="/shared/other")) == "/shared/other"


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError):
        shared_dir(session("spark://host:7077"))


def test_cuts_keep_rows(spark):
    df = spark.range(10)
    assert sorted(r.id for r in cut_lineage(df).collect()) == list(range(10))
    path = scratch_path(spark, "t")
    assert path.startswith(shared_dir(spark)) and path != scratch_path(spark, "t")
    assert sorted(r.id for r in write_through(df, path).collect()) == list(range(10))
