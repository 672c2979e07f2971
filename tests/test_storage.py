from __future__ import annotations

import os
import time
from datetime import datetime, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stratakeep.plans.warehouse import Warehouse
from stratakeep.sources import append_load, read_landing, read_loads, read_table, replace_table, scratch_path, split_landing, stage
from stratakeep.sources.buckets import SHUFFLE_CLEANUP, BucketTable
from stratakeep.sources.landing import infer_landing_schema
from stratakeep.sources.schemas import CUSTOMER


def test_loads_are_appended_and_a_rerun_replaces_its_own(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_loads(spark, path) is None
    assert append_load(spark.range(3), path, "one") == 3
    assert append_load(spark.range(5), path, "two") == 5
    assert append_load(spark.range(4), path, "one") == 4
    assert read_loads(spark, path).count() == 9
    assert read_loads(spark, path, skip_load="one").count() == 5
    assert "load_id" not in read_loads(spark, path).columns


def test_an_empty_load_writes_nothing_and_empties_an_earlier_run(spark, tmp_path):
    path = str(tmp_path / "t")
    assert append_load(spark.range(3).where("id > 9"), path, "one") == 0
    assert not [d for d in os.listdir(path) if d.startswith("load_id")]
    assert read_loads(spark, path) is None
    assert append_load(spark.range(3), path, "one") == 3
    assert append_load(spark.range(3).where("id > 9"), path, "one") == 0
    assert read_loads(spark, path).count() == 0


def test_a_load_can_read_the_other_loads_of_its_table(spark, tmp_path):
    path = str(tmp_path / "t")
    append_load(spark.range(3), path, "one")
    stored = read_loads(spark, path, spark.range(1).schema, skip_load="two")
    assert append_load(spark.range(6).join(stored, "id", "left_anti"), path, "two") == 3
    assert sorted(r.id for r in read_loads(spark, path).collect()) == list(range(6))


def test_widened_loads_are_read_together(spark, tmp_path):
    path = str(tmp_path / "t")
    wide = spark.range(2).withColumn("more", F.lit("x"))
    append_load(spark.range(3), path, "one")
    append_load(wide, path, "two")
    for table in (read_loads(spark, path), read_loads(spark, path, wide.schema)):
        assert sorted(table.columns) == ["id", "more"]
        assert table.where("more is null").count() == 3


def test_load_names_are_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="load_id"):
        append_load(spark.range(1), str(tmp_path / "t"), "../x")


def test_replace_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_table(spark, path) is None
    replace_table(spark.range(3), path)
    replace_table(spark.range(2), path)
    assert read_table(spark, path).count() == 2


def test_scratch_uses_the_shared_folder_of_the_session(spark):
    with_folder = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs://shared/scratch/"})
    assert scratch_path(with_folder, "x").startswith("hdfs://shared/scratch/stratakeep/x-")
    without = SimpleNamespace(conf={})
    assert scratch_path(without, "x") != scratch_path(without, "x")
    assert stage(spark.range(3), "numbers").count() == 3


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_landing_reader_splits_lines_marks_files_and_rejects(spark, tmp_path):
    write(tmp_path / "customer/2019/07/01/a", '{"_id":"1","created_at":{"$date":1562173938000}}', '{"_id":"2","first_na')
    write(tmp_path / "customer/2019/07/02/b", '{"first_name":"no key"}', '{"_id":"3","emails":[]}')
    write(tmp_path / "customer/2019/08/01/c", '{"_id":"9"}')
    landed = stage(read_landing(spark, f"{tmp_path}/customer/2019/07/*/*", CUSTOMER), "landed")
    good, rejects = split_landing(landed, ["_id"])
    assert {(r["_id"], os.path.basename(r.s3_location)) for r in good.collect()} == {("1", "a"), ("3", "b")}
    assert {(r.reject_reason, r["_corrupt_record"]) for r in rejects.collect()} == {
        ("not parsed", '{"_id":"2","first_na'), ("null _id", None)
    }
    assert "_id" in infer_landing_schema(spark, f"{tmp_path}/customer/2019/08/*/*").names


def test_hub_and_link_loads_of_a_warehouse(spark, tmp_path):
    names = ("_id", "business_id", "src", "hk")
    first = Warehouse(spark, str(tmp_path), "one", datetime(2024, 2, 1, tzinfo=timezone.utc))
    assert not first.has("hub")
    with pytest.raises(LookupError):
        first.read("hub")
    ids = spark.createDataFrame([("a",), ("b",), (None,)], "_id string")
    assert first.load_hub("hub", ids, *names) == 2
    second = Warehouse(spark, str(tmp_path), "two")
    more = spark.createDataFrame([("b",), ("c",)], "_id string")
    assert second.load_hub("hub", more, *names) == 1
    assert second.load_hub("hub", more, *names) == 1
    assert second.read("hub").count() == 3
    pairs = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x")], "left_hk string, right_hk string")
    assert first.load_link("link", pairs, "lk", "src") == 2
    assert second.load_link("link", pairs, "lk", "src") == 0
    with pytest.raises(ValueError, match="mode"):
        first.load_satellite("sat", ids, "_id", "hk", "src", mode="other")


def test_writes_leave_no_shuffle_files_and_tables_are_packed(spark, tmp_path, monkeypatch):
    """On a driver that does not collect garbage, shuffles of every write would pile up."""
    monkeypatch.setattr("stratakeep.sources.tables.tempfile", SimpleNamespace(mkdtemp=lambda prefix: str(tmp_path / "shared")))
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files() -> set[str]:
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before, setting = shuffle_files(), spark.conf.get(SHUFFLE_CLEANUP)
    counts = spark.range(1000).groupBy(F.col("id") % 7).count()
    digests = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("digest")).repartition(2)
    assert append_load(digests, str(tmp_path / "table"), "one") == 20_000
    BucketTable(spark, str(tmp_path / "buckets"), ["digest"]).replace(digests)
    assert len(stage(counts, "counts").collect()) == 7
    for _ in range(100):
        left = shuffle_files() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(SHUFFLE_CLEANUP) == setting
    for table in ("table", "buckets"):
        files = list((tmp_path / table).rglob("*.parquet"))
        # 32 characters of four bits each.
        assert files and sum(file.stat().st_size for file in files) < 20_000 * 24
