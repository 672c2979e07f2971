"""Parquet tables: insert-only loads, tables written anew, staging.

An insert-only table is a directory partitioned by ``load_id``. Writing a load
replaces the partition of the same ``load_id`` and nothing else, so a load can
be run again; an empty load writes no file.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Collection, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakeep.sources.buckets import PACKED, BucketTable, shuffles_removed

LOAD_ID = "load_id"
# Scratch paths of the innermost scope.
_held: ContextVar[list[str] | None] = ContextVar("held", default=None)
_LOAD_ID_FORM = re.compile(r"[A-Za-z0-9_-]+")


def _matches(spark: SparkSession, pattern: str) -> list:
    """What the file system of the pattern holds of it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or [])


def _exists(spark: SparkSession, pattern: str) -> bool:
    return bool(_matches(spark, pattern))


def _open(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    return reader.parquet(path)


def read_loads(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    skip_load: str | Collection[str] | None = None,
    only_load: str | None = None,
    keep_load: bool = False,
) -> DataFrame | None:
    """All loads of a table without the ``load_id`` column, unless
    ``keep_load`` is set; None if it has none.

    With ``schema`` no file footer is read up front and columns a load lacks
    are null; without it the schemas of all loads are merged. ``skip_load``
    (one or more) leaves out loads and ``only_load`` all others, by partition pruning.
    """
    if schema is not None:
        fields = [field for field in schema.fields if field.name != LOAD_ID]
        schema = T.StructType([*fields, T.StructField(LOAD_ID, T.StringType())])
    if not _exists(spark, f"{path}/{LOAD_ID}=*"):
        return None
    table = _open(spark, path, schema)
    skipped = [skip_load] if isinstance(skip_load, str) else list(skip_load or ())
    if skipped:
        table = table.where(~F.col(LOAD_ID).isin(*skipped))
    if only_load is not None:
        table = table.where(F.col(LOAD_ID) == only_load)
    return table if keep_load else table.drop(LOAD_ID)


def append_load(df: DataFrame, path: str, load_id: str, more: bool = False) -> int:
    """Write ``df`` as one load and return its number of rows.

    Rows are counted while they are written, so the plan runs once. If a rerun
    of a load comes out empty, what an earlier run left under it is emptied. With ``more``
    the rows are added to those that this run has written of the load.
    """
    if not _LOAD_ID_FORM.fullmatch(load_id):
        raise ValueError(f"load_id {load_id!r}: use letters, digits, '_' and '-'")
    counted = Observation()
    with shuffles_removed(df.sparkSession):
        (
            df.observe(counted, F.count(F.lit(1)).alias("rows"))
            .withColumn(LOAD_ID, F.lit(load_id))
            .write.mode("append" if more else "overwrite")
            .options(partitionOverwriteMode="dynamic", **PACKED)
            .partitionBy(LOAD_ID)
            .parquet(path)
        )
    rows = counted.get["rows"]
    if rows == 0 and not more:
        earlier = f"{path}/{LOAD_ID}={load_id}"
        if _exists(df.sparkSession, earlier):
            df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(earlier)
    return rows


def loads_of(spark: SparkSession, path: str) -> set[str]:
    """Names of the loads that a table holds rows of."""
    found = _matches(spark, f"{path}/{LOAD_ID}=*")
    return {status.getPath().getName().removeprefix(f"{LOAD_ID}=") for status in found}


def replace_table(df: DataFrame, path: str) -> None:
    """Write a table anew. What was there before stays readable until the new
    rows are complete, so a write that fails loses nothing, and ``df`` may read it."""
    BucketTable(df.sparkSession, path, df.columns).replace(df)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A table written by ``replace_table``; None if it was never written."""
    return BucketTable(spark, path, ()).read(schema)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting, such as a test, gets a
    temporary folder; on a cluster the setting is required, because its
    executors do not see each other's disks.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.conf.get("spark.master", "local")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="stratakeep-")
    path = f"{shared.rstrip('/')}/stratakeep/{name}-{uuid.uuid4().hex}"
    held = _held.get()
    if held is not None:
        held.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Own what is staged inside: it is removed at the end, also after an error.

    DataFrames that read staged rows must not be used after it.
    """
    token = _held.set([])
    try:
        yield
    finally:
        paths = _held.get()
        _held.reset(token)
        for name in paths:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to scratch once and read it back.

    Several loads read the same landed rows: staging parses the text once,
    lets each load read only its columns, cuts lineage and survives the loss
    of executors.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_parts(spark: SparkSession, parts: Iterable[DataFrame], name: str) -> DataFrame:
    """``stage`` for rows in one or more frames, computed one after the other and packed as tables are."""
    path = scratch_path(spark, name)
    for df in parts:
        with shuffles_removed(spark):
            df.write.mode("append").options(**PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
