from __future__ import annotations

import hashlib
from datetime import date, datetime

from pyspark.sql import functions as F

from stratakeep.functions import convert_unix_time, joined_hash, key_hash, row_hash


def md5(text: str) -> str:
    return hashlib.md5(text.encode("utf-8")).hexdigest()


def test_hash_keys(spark):
    df = spark.createDataFrame([("abc|é", "x"), (None, "y")], "a string, b string")
    rows = df.select(key_hash("a").alias("k"), joined_hash(["b", "a"]).alias("l")).collect()
    assert rows[0].k == md5("abc|é")
    assert rows[0].l == md5("x|abc|é")
    assert rows[1].k is None and rows[1].l is None


def test_row_hash_orders_columns_by_name_and_counts_null_as_space(spark):
    df = spark.createDataFrame([(1, None, True, "t")], "c long, a string, b boolean, d string")
    assert df.select(row_hash(["d", "c", "a", "b"]).alias("h")).first().h == md5(" |true|1|t")
    space = df.withColumn("a", F.lit(" "))
    assert space.select(row_hash(["a", "b", "c", "d"]).alias("h")).first().h == md5(" |true|1|t")


def test_hash_of_timestamps_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([((1562173938123,),)], "at struct<`$date`: long>")
    digests = set()
    for zone in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        digests.add(convert_unix_time(df, ["at"]).select(row_hash(["at_ts"]).alias("h")).first().h)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert digests == {md5("2019-07-03 17:12:18.123")}


def test_unix_time_replaces_columns_at_the_end_and_skips_absent_ones(spark):
    df = spark.createDataFrame([((1562173938000,), None, "x")], "a struct<`$date`: long>, b struct<`$date`: long>, c string")
    out = convert_unix_time(df, ["b", "a", "gone"])
    assert out.columns == ["c", "b_ts", "a_ts"]
    row = out.first()
    assert row.a_ts == datetime(2019, 7, 3, 17, 12, 18) and row.b_ts is None


def test_unix_time_legacy_gives_the_literal_date(spark):
    df = spark.createDataFrame([((1562173938000,),)], "a struct<`$date`: long>")
    assert convert_unix_time(df, ["a"], legacy=True).first().a_ts == date(1970, 1, 1)
