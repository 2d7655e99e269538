"""Checkpointed sinks: appended files, and whole batches."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telestrata.settings import Settings
from telestrata.sources.batches import write_batch
from telestrata.sources.layers import DATE_COLUMN
from telestrata.streaming.metrics import StreamTotals


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    settings: Settings,
    name: str,
    drain: bool = False,
    by_date: bool = False,
) -> StreamingQuery:
    """Append to a Parquet folder; each batch is committed exactly once.

    ``drain`` processes what is there, in admitted batches, and ends; otherwise
    the query runs on a fixed interval. ``by_date`` partitions by event date.
    """
    trigger = {"availableNow": True} if drain else {"processingTime": settings.trigger_interval}
    if by_date:
        df = df.withColumn(DATE_COLUMN, F.to_date("timestamp"))
    writer = (
        df.writeStream.format("parquet")
        .queryName(name)
        .outputMode(settings.output_mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    if by_date:
        writer = writer.partitionBy(DATE_COLUMN)
    return writer.start()


def batch_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    settings: Settings,
    name: str,
    drain: bool = False,
    by_date: bool = False,
) -> StreamingQuery:
    """Write each micro-batch as one folder of a batch layer.

    A batch that runs again after a failure replaces what it wrote, so every row is there once.
    Files hold whole dates, not one part of each date per task.
    """
    trigger = {"availableNow": True} if drain else {"processingTime": settings.trigger_interval}
    if by_date:
        df = df.withColumn(DATE_COLUMN, F.to_date("timestamp"))
    writer = df.writeStream.queryName(name).outputMode(settings.output_mode)
    writer = writer.option("checkpointLocation", checkpoint).trigger(**trigger)
    return writer.foreachBatch(lambda rows, batch_id: write_batch(rows, path, batch_id)).start()


def drained(query: StreamingQuery, timeout_seconds: float | None = None) -> StreamTotals:
    """Wait for a draining query and return the totals of all its batches.

    A failure is raised. There is no time limit unless one is given; an overrun of it stops
    the query and is raised.
    """
    totals, start = StreamTotals(query), time.monotonic()
    while not query.awaitTermination(0.5):
        totals.fold()
        if timeout_seconds is not None and time.monotonic() - start > timeout_seconds:
            query.stop()
            raise TimeoutError(f"stream {query.name} did not drain in {timeout_seconds} s")
    totals.fold()
    return totals
