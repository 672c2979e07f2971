from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from stratakeep.sources import buckets
from stratakeep.sources.buckets import BUCKET, BucketTable
from stratakeep.sources.tables import read_table, replace_table


def keys(df):
    return sorted((row["id"], row["v"]) for row in df.collect())


@pytest.fixture
def dealt(monkeypatch):
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 10)


def numbers(spark, n, v):
    return spark.range(n).withColumn("v", F.lit(v))


def test_only_touched_buckets_are_written_and_read(spark, tmp_path, dealt):
    table = BucketTable(spark, str(tmp_path / "t"), ["id"])
    assert table.read() is None and table.newest() is None and table.touched(spark.range(3)) == []
    assert table.replace(numbers(spark, 100, 0), "one", rows=100).buckets == 10
    assert keys(table.read()) == [(i, 0) for i in range(100)]
    changed = spark.range(7, 8)
    touched = table.touched(changed)
    assert len(touched) == 1
    held = table.read(buckets=touched)
    assert all(f"{BUCKET}={touched[0]}/" in name for name in held.inputFiles())
    table.update(held.withColumn("v", F.when(F.col("id") == 7, 1).otherwise(F.col("v"))), "two")
    assert keys(table.read()) == [(i, int(i == 7)) for i in range(100)]
    assert table.newest().load_id == "two" and not table.newest().full
    written = glob.glob(str(tmp_path / "t" / "batch=00000002-*" / f"{BUCKET}=*"))
    assert [os.path.basename(name) for name in written] == [f"{BUCKET}={touched[0]}"]


def test_superseded_directories_go_and_the_state_before_stays_readable(spark, tmp_path, dealt):
    table = BucketTable(spark, str(tmp_path / "t"), ["id"])
    table.replace(numbers(spark, 40, 0), rows=40)
    for v in range(1, 6):
        before = table.read()
        table.update(numbers(spark, 40, v).where("id = 3").unionByName(before.where("id != 3")))
        assert dict(keys(before))[3] == v - 1 and dict(keys(table.read()))[3] == v
    table.replace(numbers(spark, 2, 9))
    assert keys(table.read()) == [(0, 9), (1, 9)]
    table.replace(numbers(spark, 1, 9))
    assert keys(table.read()) == [(0, 9)]
    assert len(glob.glob(str(tmp_path / "t" / "*" / f"{BUCKET}=*"))) == 2


def test_a_broken_write_leaves_the_state_before(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(numbers(spark, 5, 0), path)
    broken = numbers(spark, 5, 1).repartition(4).withColumn("v", F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        replace_table(broken, path)
    assert keys(read_table(spark, path)) == [(i, 0) for i in range(5)]
    # A writer that died left files, but no marker.
    half = BucketTable(spark, path, ["id"])._next(True, 1, "dead")
    os.makedirs(os.path.join(path, half.name, f"{BUCKET}=0"))
    assert keys(read_table(spark, path)) == [(i, 0) for i in range(5)]
    # It may read what it replaces.
    replace_table(read_table(spark, path).withColumn("v", F.lit(2)), path)
    assert keys(read_table(spark, path)) == [(i, 2) for i in range(5)]


def test_an_empty_state(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(numbers(spark, 0, 0), path)
    table = read_table(spark, path, numbers(spark, 0, 0).schema)
    assert table.count() == 0
    with pytest.raises(LookupError):
        BucketTable(spark, str(tmp_path / "none"), ["id"]).update(numbers(spark, 1, 0))


def test_several_tasks_write_a_bucket(spark, tmp_path, dealt):
    """So that the few buckets of a middling table do not leave most cores idle."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = BucketTable(spark, str(tmp_path / "t"), ["id"])
        table.replace(numbers(spark, 20, 1), rows=20)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(glob.glob(f"{tmp_path}/t/batch=*/{BUCKET}=*")) == 2
    assert len(glob.glob(f"{tmp_path}/t/batch=*/{BUCKET}=*/*.parquet")) > 2
    assert keys(table.read()) == [(n, 1) for n in range(20)]
