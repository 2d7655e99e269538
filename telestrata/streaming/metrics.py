"""Totals of streaming queries as DataFrames."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

TOTALS_SCHEMA = (
    "layer string, records bigint, batches bigint, busy_ms bigint, last_ms bigint, "
    "late bigint, state_rows bigint, first_at string, last_at string, failed boolean"
)


class StreamTotals:
    """Sums over every batch of a query, folded in while it runs.

    Spark keeps the reports of the last batches only
    (``spark.sql.streaming.numRecentProgressUpdates``), so ``fold`` has to be called more often
    than that. A gap between the reports means that some were missed, and is raised.
    """

    def __init__(self, query: StreamingQuery):
        self.query = query
        self.last_batch: int | None = None
        self.records = self.batches = self.busy_ms = self.last_ms = 0
        self.late = self.state_rows = 0
        self.first_at = self.last_at = None

    @property
    def failed(self) -> bool:
        return self.query.exception() is not None

    def fold(self) -> "StreamTotals":
        """Take in the reports that are new since the last call."""
        return self.take(json.loads(r.json) for r in self.query.recentProgress)

    def take(self, reports: Iterable[Mapping]) -> "StreamTotals":
        # A trigger that finds nothing to do reports too, but runs no batch.
        ran = [r for r in reports if "addBatch" in r["durationMs"]]
        for r in ran:
            if self.last_batch is not None and r["batchId"] <= self.last_batch:
                continue
            expected = r["batchId"] if self.last_batch is None else self.last_batch + 1
            if r["batchId"] != expected:
                raise RuntimeError(f"reports of batches {expected} to {r['batchId'] - 1} are gone")
            self.last_batch = r["batchId"]
            self.batches += 1
            self.records += r["numInputRows"]
            self.last_ms = r["durationMs"].get("triggerExecution", 0)
            self.busy_ms += self.last_ms
            self.late += sum(s["numRowsDroppedByWatermark"] for s in r["stateOperators"])
            self.state_rows = sum(s["numRowsTotal"] for s in r["stateOperators"])
            self.first_at = self.first_at or r["timestamp"]
            self.last_at = r["timestamp"]
        return self


def totals_frame(spark: SparkSession, runs: Mapping[str, StreamTotals]) -> DataFrame:
    """One row per query with the totals of all its batches."""
    rows = [
        (layer, t.records, t.batches, t.busy_ms, t.last_ms, t.late, t.state_rows, t.first_at,
         t.last_at, t.failed)
        for layer, t in runs.items()
    ]
    stamps = {c: F.to_timestamp(c) for c in ("first_at", "last_at")}
    return spark.createDataFrame(rows, TOTALS_SCHEMA).withColumns(stamps)


def layer_metrics(totals: DataFrame) -> DataFrame:
    """Records, batches, errors, last duration, uptime and rate per layer."""
    seconds = F.unix_timestamp("last_at") - F.unix_timestamp("first_at")
    return totals.select(
        "layer",
        F.col("records").alias("records_processed"),
        F.col("batches").alias("batches_completed"),
        F.col("failed").cast("bigint").alias("errors"),
        F.col("last_ms").alias("last_batch_duration_ms"),
        F.round(seconds + F.col("last_ms") / F.lit(1000.0), 2).alias("uptime_seconds"),
        F.col("late").alias("late_rows"),
        F.round(
            F.try_divide(F.col("records").cast("double"), F.col("busy_ms") / F.lit(1000.0)), 2
        ).alias("records_per_second"),
    )
