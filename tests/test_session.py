import os
from types import SimpleNamespace

import pytest

from cladeworks import session
from cladeworks.operators import heavy_keys


def fake(master, found):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, d=None: found, set=lambda k, v: None), sparkContext=SimpleNamespace(master=master),
    )


def test_a_cluster_needs_a_shared_folder():
    for master in ("spark://h:7077", "yarn", "k8s://x", "local-cluster[3,2,1000]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(fake(master, None))
        assert session.shared_dir(fake(master, "/shared")) == "/shared"
    assert session.shared_dir(fake("local[4]", None)).startswith("/")


def test_release_leaves_nothing_behind(spark):
    folder = session.shared_dir(spark).removeprefix("file:")
    since = session.mark()
    before = set(os.listdir(folder))
    df = spark.createDataFrame([("x", "y"), ("X", "y")], "genus string, species string")
    assert heavy_keys.taxa(df).count() == 1
    assert set(os.listdir(folder)) > before
    assert session.release(spark, since) > 0 and set(os.listdir(folder)) == before
