"""Loads of several targets that change together or not at all."""

import os

import pytest

from shopflow.sources import sinks


def _targets(tmp):
    return [sinks.file_target("a", f"{tmp}/a", "parquet"), sinks.file_target("b", f"{tmp}/b", "orc"),
            sinks.file_target("c", f"{tmp}/c", "json")]


def _ids(spark, targets, m):
    return [sorted(r.id for r in df.collect()) for df in sinks.read_together(spark, targets, m)]


def test_failed_second_target_leaves_both_old(spark, tmp):
    targets, m = _targets(tmp)[:2], f"{tmp}/commits"
    first = sinks.write_together(spark.range(3), targets, m)
    assert first["commit"] == "000000000001" and [x["rows"] for x in first["loads"]] == [3, 3]
    broken = [targets[0], sinks.file_target("b", f"{tmp}/b", "no such format")]
    with pytest.raises(Exception):
        sinks.write_together(spark.range(9), broken, m)
    assert _ids(spark, targets, m) == [[0, 1, 2], [0, 1, 2]]
    sinks.write_together(spark.range(5, 7), targets, m)
    assert _ids(spark, targets, m) == [[5, 6], [5, 6]]


def test_readers_keep_their_commit_and_old_folders_go(spark, tmp):
    targets, m = _targets(tmp), f"{tmp}/commits"
    sinks.write_together(spark.range(2), targets, m)
    reading = sinks.read_together(spark, targets, m)
    sinks.write_together(spark.range(4), targets, m)
    assert [df.count() for df in reading] == [2, 2, 2]           # their folders are still there
    assert [df.count() for df in sinks.read_together(spark, targets, m)] == [4, 4, 4]
    with pytest.raises(Exception):                                # a failed load leaves a folder
        sinks.write_together(spark.range(1).selectExpr("id", "raise_error('x') as e"), targets, m)
    sinks.write_together(spark.range(6), targets, m)
    assert sinks.forget_old(spark, targets, m, keep=1) >= 6
    assert [df.count() for df in sinks.read_together(spark, targets, m)] == [6, 6, 6]
    assert len([d for d in os.listdir(f"{tmp}/a")]) == 1


def test_first_target_is_computed_once_and_copied(spark, tmp):
    """Later targets hold what the first holds, even of a frame that would
    come out differently a second time."""
    from pyspark.sql import functions as F
    targets, m = _targets(tmp)[:2], f"{tmp}/commits"
    sinks.write_together(spark.range(50).withColumn("x", F.uuid()), targets, m)
    a, b = sinks.read_together(spark, targets, m)
    assert a.exceptAll(b).count() == 0
    sinks.write_all(spark.range(50).withColumn("x", F.uuid()), [t.at(f"{t.location}_plain") for t in targets])
    a, b = (sinks.read_table(spark, t.at(f"{t.location}_plain")) for t in targets)
    assert a.exceptAll(b).count() == 0


def test_database_targets_are_refused(spark, tmp):
    with pytest.raises(ValueError):
        sinks.write_together(spark.range(1), [sinks.jdbc_target("x", "jdbc:derby:memory:x", "X")], f"{tmp}/m")
