"""Landed files as a stream into the same landing jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stratakeep.plans.pipelines import DEFAULT, LANDING_JOBS, JobOptions
from stratakeep.plans.warehouse import Warehouse
from stratakeep.sources.landing import read_landing
from stratakeep.sources.schemas import LANDING_SCHEMAS
from stratakeep.sources.tables import scratch_scope


def stream_landing(
    spark: SparkSession,
    source: str,
    path: str,
    root: str,
    checkpoint: str,
    max_files: int | None = None,
    options: JobOptions = DEFAULT,
) -> StreamingQuery:
    """Load files as they arrive under ``path``, then stop when none is left.

    Each micro-batch is one load named after the stream and its batch number,
    so a batch that is replayed after a failure replaces what it wrote before.
    The stream's name is the id that Spark keeps in ``checkpoint``, the stream's
    own progress folder: another folder or checkpoint is another stream, and
    their loads stand side by side. ``source`` is one of customer, cart,
    cart_item and product.
    """
    job = LANDING_JOBS[source]

    def load(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load_id = f"stream-{source}-{stream}-{batch_id}"
        with scratch_scope(batch.sparkSession):
            job(Warehouse(batch.sparkSession, root, load_id, owner=f"stream {stream}"), batch, options)

    landed = read_landing(spark, path, LANDING_SCHEMAS[source], streaming=True, max_files=max_files)
    return (
        landed.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
