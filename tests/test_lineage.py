"""Lineage cuts: stored copies in the shared checkpoint folder, and null-safe helper joins."""

from __future__ import annotations

import pytest

from tradeflow.plans import lineage


def test_materialize_stores_under_the_shared_checkpoint_folder(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "x")
    stored = lineage.materialize(df, "probe")
    assert stored.count() == 100
    files = stored.inputFiles()
    root = lineage.shared_checkpoint_dir(spark)
    assert files and all(root.split(":")[-1] in f for f in files)


def test_materialize_under_a_given_root(spark, tmp_path):
    stored = lineage.materialize(spark.range(3), "probe", str(tmp_path / "staging"))
    assert all(str(tmp_path) in f for f in stored.inputFiles())


def test_a_cluster_without_a_checkpoint_folder_is_refused(spark):
    class Context:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        lineage.shared_checkpoint_dir(Session)


def test_null_safe_join_matches_null_keys(spark):
    left = spark.createDataFrame([("a", 1, 10), (None, 1, 20), ("a", None, 30)], "k string, d int, x int")
    right = spark.createDataFrame([("a", 1, "p"), (None, 1, "q"), ("a", None, "r")], "k string, d int, y string")
    rows = {(r.x, r.y) for r in lineage.join_null_safe(left, right, ["k", "d"]).collect()}
    assert rows == {(10, "p"), (20, "q"), (30, "r")}
