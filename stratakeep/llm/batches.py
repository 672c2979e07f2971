"""Python functions over Arrow batches, one text at a time with bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows handled at once in Python; a slice of an Arrow batch.
SLICE_ROWS = 512

Chunk = list[str]


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_texts(
    df: DataFrame,
    carried: Sequence[str],
    text: str,
    fields: str,
    start: Callable[[], Callable[[Chunk], list[pa.Array]]],
) -> DataFrame:
    """The ``carried`` columns of ``df`` with new columns made from its texts.

    ``start`` runs once per task and returns a function from a list of texts
    (null becomes the empty text) to one Arrow array per new field, so
    models and caches are made once per task. ``fields`` is the DDL of the new
    columns. A carried column of the same name is replaced by the new one.
    """
    added = T.StructType.fromDDL(fields)
    new = added.names
    kept = [name for name in carried if name not in new]
    # A text that is carried anyway is not sent twice.
    extra = [] if text in kept else [F.col(text).alias("_text")]
    source = df.select(*kept, *extra)
    at = kept.index(text) if text in kept else len(kept)
    schema = T.StructType([*source.schema.fields[: len(kept)], *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for part in slices(batches):
            columns = [part.column(i) for i in range(len(kept))]
            made = make([x or "" for x in part.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*columns, *made], names=[*kept, *new])

    return source.mapInArrow(run, schema)


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of a key as text, modulo ``modulus``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus
