import time

import pytest
from pyspark.sql import functions as F

from scrubjay.session import scratch_path
from scrubjay.sources import versions


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_an_overwrite_of_itself_keeps_older_versions_readable(spark):
    path = scratch_path(spark, "t-versions")
    first = versions.publish(spark.range(5), path)
    for _ in range(2):
        old = versions.read_table(spark, path)
        versions.publish(old.withColumn("id", F.col("id") * 2), path)
    assert versions.versions(spark, path) == [1, 2, 3]
    assert rows(versions.read_table(spark, path)) == [(0,), (4,), (8,), (12,), (16,)]
    assert rows(first) == rows(versions.read_table(spark, path, 1)) == [(i,) for i in range(5)]
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, path, 9)
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, scratch_path(spark, "t-none"))


def test_a_writer_killed_midway_leaves_the_old_rows(spark):
    path = scratch_path(spark, "t-killed")
    versions.publish(spark.range(100), path)

    def dies(batches):
        for batch in batches:
            if batch.num_rows and batch.column(0)[-1].as_py() > 900:
                raise RuntimeError("lost")
            yield batch
    broken = versions.read_table(spark, path).unionAll(spark.range(1000)).repartitionByRange(8, "id").mapInArrow(dies, "id long")
    with pytest.raises(Exception, match="lost"):
        versions.publish(broken, path)
    assert versions.versions(spark, path) == [1] and versions.read_table(spark, path).count() == 100


def test_a_writer_killed_before_its_commit_changes_nothing(spark, monkeypatch):
    path = scratch_path(spark, "t-uncommitted")
    versions.publish(spark.range(3), path)
    with monkeypatch.context() as m:
        m.setattr(versions._Store, "rename", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            versions.publish(spark.range(50), path)
    assert versions.read_table(spark, path).count() == 3
    assert versions.release(spark, path) == 0  # a writer at work: too young to be a leftover
    time.sleep(0.05)
    assert versions.release(spark, path, grace_seconds=0) == 1
    assert versions.read_table(spark, path).count() == 3
    assert [n for n, _ in versions._Store(spark, path).names("commits")] == ["000000000001"]


def test_two_writers_of_one_version(spark):
    path = scratch_path(spark, "t-two")
    versions.publish(spark.range(1), path, expect=0)
    versions.publish(spark.range(2), path, expect=1)
    with pytest.raises(versions.TableChanged):
        versions.publish(spark.range(3), path, expect=1)
    assert versions.read_table(spark, path).count() == 2
    store = versions._Store(spark, path)
    store.write("commits/.late", "x")
    assert not store.rename("commits/.late", "commits/000000000002")  # a taken number is never replaced
    assert versions.read_table(spark, path).count() == 2


def test_release_keeps_the_newest(spark):
    path = scratch_path(spark, "t-release")
    for n in range(1, 5):
        versions.publish(spark.range(n).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    assert versions.release(spark, path, keep=2) == 2 and versions.versions(spark, path) == [3, 4]
    assert versions.read_table(spark, path).count() == 4 and versions.read_table(spark, path, 3).count() == 3
    versions.publish(spark.range(0).withColumn("p", F.lit(1)), path, partition_by=["p"])
    with pytest.raises(ValueError):
        versions.release(spark, path, keep=0)


def test_a_plain_reader_sees_no_mixture(spark):
    path = scratch_path(spark, "t-plain")
    versions.publish(spark.range(3), path)
    versions.publish(spark.range(4), path)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
