"""Tables with one current state, replaced as a whole or by key bucket.

Rows are dealt into buckets by a hash of their key. Every write is a batch, a
directory of its own below the table, with a directory per bucket it holds. A
batch counts from the moment its ``_SUCCESS`` marker is there, and a bucket is
read from the newest batch that holds it, back to the last full one. So
a write that breaks off leaves the state before it, readers never see
half of a write, and a small write touches few buckets.

The name of a batch tells its number, whether it is full, the number of
buckets and the load it stands for.
"""

from __future__ import annotations

import math
import re
from collections.abc import Collection, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows that a bucket should hold, and the most buckets of a table.
BUCKET_ROWS = 1_000_000
MOST_BUCKETS = 4096
# Tasks that write the rows of one bucket, so that a few buckets keep all cores busy.
BUCKET_WRITERS = 4
# Buckets are dealt anew when they hold so many times the rows wanted.
OVERFULL = 4
# Rows that a write shuffles at once. A write of more rows is done in slices of keys, one
# after the other, so that the disk holds the shuffle of one slice; every
# slice reads the input again, hence the most slices.
SLICE_ROWS = 4_000_000
MOST_SLICES = 16
# Buckets that a slice of a bucket table holds at least, so that their writers keep all cores busy.
SLICE_BUCKETS = 2

BUCKET = "_bucket"
# How Parquet is compressed: most of a row are digests in hex, which only a codec
# that codes single characters makes smaller (to little over half).
COMPRESSION = "zstd"
# Texts are written as what they do not share with the one before, lengths apart from characters.
PACKED = {"compression": COMPRESSION, "parquet.writer.version": "PARQUET_2_0"}
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = re.compile(r"batch=(\d{8})-(full|part)-(\d+)-(.*)")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files when they end.

    Otherwise these stay until the driver's garbage collector finds their plans,
    which in a long job is after the disk holds the shuffles of many writes.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def slices_for(rows: int) -> int:
    """In how many slices so many rows are shuffled."""
    return min(MOST_SLICES, max(1, math.ceil(rows / SLICE_ROWS)))


def slice_of(df: DataFrame | None, key: Column | str, i: int, n: int) -> DataFrame | None:
    """The rows of slice ``i`` of ``n``; equal keys are in one slice, null ones, too."""
    if df is None or n == 1:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i)


@dataclass(frozen=True, order=True)
class Batch:
    number: int
    full: bool
    buckets: int
    load_id: str

    @property
    def name(self) -> str:
        return f"batch={self.number:08d}-{'full' if self.full else 'part'}-{self.buckets}-{self.load_id}"


class BucketTable:
    """A table under ``path`` whose rows belong to the key columns ``keys``."""

    def __init__(self, spark: SparkSession, path: str, keys: Collection[str]) -> None:
        self.spark, self.path, self.keys = spark, path, list(keys)
        self._root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _listed(self, pattern: str) -> list[str]:
        """Names that match below the table, in order."""
        found = self._files.globStatus(self._root.suffix(f"/{pattern}")) or []
        whole = [status.getPath().toString().split("/") for status in found]
        return sorted("/".join(parts[-(pattern.count("/") + 1) :]) for parts in whole)

    def _batches(self) -> list[Batch]:
        """Finished batches, oldest first."""
        names = [name.split("/")[0] for name in self._listed("batch=*/_SUCCESS")]
        found = [match for match in map(_BATCH.fullmatch, names) if match]
        return sorted(Batch(int(m[1]), m[2] == "full", int(m[3]), m[4]) for m in found)

    def newest(self) -> Batch | None:
        batches = self._batches()
        return batches[-1] if batches else None

    def _state(self, batches: list[Batch]) -> dict[int, str]:
        """The directory of every bucket after these batches, below the table."""
        last_full = max((i for i, batch in enumerate(batches) if batch.full), default=len(batches))
        counting = {batch.name for batch in batches[last_full:]}
        out = {}
        # Names sort by batch number, so the newest of a bucket comes last.
        for name in self._listed(f"batch=*/{BUCKET}=*"):
            if name.split("/")[0] in counting:
                out[int(name.rsplit("=", 1)[1])] = name
        return out

    def bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(n)).cast("int")

    def read(self, schema: T.StructType | None = None, buckets: Collection[int] | None = None) -> DataFrame | None:
        """The current rows, of some buckets if given; None if never written.

        What was read stays readable until a second further batch is written.
        """
        if self.newest() is None:
            return None
        current = self._state(self._batches())
        paths = [f"{self.path}/{name}" for bucket, name in current.items() if buckets is None or bucket in buckets]
        if not paths:
            if schema is None:
                any_file = next(iter(current.values()), None)
                if any_file is None:
                    return None
                schema = self.spark.read.parquet(f"{self.path}/{any_file}").schema
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*paths)

    def _write(self, df: DataFrame, batch: Batch, buckets: Collection[int] | None = None) -> None:
        """Write rows of some buckets, of all by default, slice by slice."""
        numbers = sorted(range(batch.buckets) if buckets is None else buckets)
        n = min(MOST_SLICES, max(1, math.ceil(len(numbers) / SLICE_BUCKETS)))
        bucket = self.bucket(batch.buckets)
        slices = [df] if n == 1 else [df.where(bucket.isin(numbers[i::n])) for i in range(n)]
        dealt = (rows.withColumn(BUCKET, bucket) for rows in slices)
        if batch.buckets > 1:
            dealt = (rows.repartition(BUCKET, F.pmod(F.hash(*self.keys), F.lit(BUCKET_WRITERS))) for rows in dealt)
        self._write_dealt(dealt, n, batch)

    def _write_dealt(self, frames: Iterable[DataFrame], n: int, batch: Batch) -> None:
        """Write ``n`` frames as one batch, which counts when the last of them is written."""
        marker = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
        for i, rows in enumerate(frames):
            with shuffles_removed(self.spark):
                writer = rows.write.mode("append").options(**PACKED, **{marker: "true" if i == n - 1 else "false"})
                writer.partitionBy(BUCKET).parquet(f"{self.path}/{batch.name}")

    def remove_before(self) -> None:
        """Remove the state before this one, when nothing reads it any more."""
        self._remove_superseded(before=False)

    def _remove_superseded(self, before: bool = True) -> None:
        """Remove what neither this state nor, with ``before``, the one before it reads."""
        batches = self._batches()
        kept = {*self._state(batches).values(), *(self._state(batches[:-1]).values() if before else ())}
        finished = {batch.name: batch for batch in batches}
        holding = {name.split("/")[0] for name in kept}
        for name in self._listed("batch=*"):
            batch = finished.get(name)
            # The marker of a full batch tells where the state begins.
            if name not in holding and batch not in batches[-2:] and not (batch and batch.full):
                self._files.delete(self._root.suffix(f"/{name}"), True)
        for name in self._listed(f"batch=*/{BUCKET}=*"):
            if name not in kept:
                self._files.delete(self._root.suffix(f"/{name}"), True)

    def _next(self, full: bool, buckets: int, load_id: str) -> Batch:
        # Also past broken batches, whose directories hold no marker.
        numbers = [int(match[1]) for match in map(_BATCH.fullmatch, self._listed("batch=*")) if match]
        return Batch(max(numbers, default=0) + 1, full, buckets, load_id)

    def replace(self, df: DataFrame, load_id: str = "", rows: int | None = None) -> Batch:
        """Write all rows. ``rows`` sizes the buckets if known, one by default."""
        n = min(MOST_BUCKETS, max(1, math.ceil((rows or 0) / BUCKET_ROWS)))
        batch = self._next(True, n, load_id)
        self._write(df, batch)
        self._remove_superseded()
        return batch

    def replace_parts(self, parts: Iterable[DataFrame], n: int, load_id: str = "") -> Batch:
        """Write all rows, given in ``n`` frames that are computed one after the other."""
        batch = self._next(True, n, load_id)
        self._write_dealt((rows.withColumn(BUCKET, F.lit(i)) for i, rows in enumerate(parts)), n, batch)
        self._remove_superseded()
        return batch

    def update(self, df: DataFrame, load_id: str = "", buckets: Collection[int] | None = None) -> Batch:
        """Replace every bucket that ``df`` has rows of by these rows.

        ``buckets`` are those it may have rows of, if known.
        """
        newest = self.newest()
        if newest is None:
            raise LookupError(f"{self.path} has no state to update")
        batch = self._next(False, newest.buckets, load_id)
        self._write(df, batch, buckets)
        self._remove_superseded()
        return batch

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of the keys given, at most as many as the table has."""
        newest = self.newest()
        if newest is None:
            return []
        if newest.buckets == 1:
            return [0]
        return [row[0] for row in keys.select(self.bucket(newest.buckets)).distinct().collect()]

    def overfull(self, rows: int) -> bool:
        newest = self.newest()
        return newest is not None and newest.buckets < MOST_BUCKETS and rows > OVERFULL * BUCKET_ROWS * newest.buckets

    def drop(self) -> None:
        """Forget the state, so that the next writer builds it anew."""
        self._files.delete(self._root, True)
