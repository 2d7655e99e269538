"""Compaction and retention over the stored tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from telestrata.operators.windows import GOLD_TABLES
from telestrata.settings import Settings
from telestrata.sources import batches, snapshots
from telestrata.sources.layers import read_layer
from telestrata.sources.storage import together

RESULT_SCHEMA = "layer string, action string, status string, files_changed bigint"


def snapshot_streamed_layer(spark: SparkSession, streamed_path: str, table_path: str):
    """Copy a layer that a stream writes into a versioned table.

    Files inside a streamed folder are tracked by the sink and must not be
    rewritten, so maintenance works on the copy.
    """
    return snapshots.commit(read_layer(spark, streamed_path), table_path, operation="SNAPSHOT")


def maintain_batches(
    spark: SparkSession,
    layers: Mapping[str, str],
    config: Settings | Mapping | None = None,
    target_bytes: int = batches.TARGET_BYTES,
    now: datetime | None = None,
) -> DataFrame:
    """Compact and expire the batch layers that streams write, in place.

    ``layers`` names their folders as ``Bronze`` and ``Silver``. One row per layer and action;
    unexpected errors are raised.
    """
    settings = Settings.of(config)
    hours = {"Bronze": settings.bronze_retention_hours, "Silver": settings.silver_retention_hours}
    results = []
    for label, path in layers.items():
        if settings.optimize_enabled:
            done = batches.compact_batches(spark, path, target_bytes)
            results.append((label, "compact", "compacted" if done else "nothing to do", len(done)))
        if settings.vacuum_enabled:
            removed = batches.expire_batches(spark, path, hours[label], now)
            status = "kept forever" if hours[label] <= 0 else "expired"
            results.append((label, "expire", status, len(removed)))
    return spark.createDataFrame(results, RESULT_SCHEMA)


def run_maintenance(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    gold_path: str,
    config: Settings | Mapping | None = None,
    target_bytes: int = 128 * 1024 * 1024,
) -> DataFrame:
    """Compact and expire every table by the policy of its layer; one result row
    per table and action. Unexpected errors are raised.

    A compaction has no more tasks than files it writes, so the tables are taken together.
    """
    settings = Settings.of(config)
    targets = [
        ("Bronze", bronze_path, settings.bronze_retention_hours),
        ("Silver", silver_path, settings.silver_retention_hours),
    ]
    targets += [
        (f"Gold/{name}", f"{gold_path}/{name}", settings.gold_retention_hours)
        for name in GOLD_TABLES
    ]

    def maintained(target: tuple[str, str, float]) -> list[tuple]:
        label, path, retention = target
        results = []
        if settings.optimize_enabled:
            done = snapshots.compact(spark, path, target_bytes)
            status = "compacted" if done else "nothing to do"
            results.append((label, "compact", status, done.num_files if done else 0))
        if settings.vacuum_enabled:
            removed = snapshots.expire(spark, path, retention)
            status = "kept forever" if retention <= 0 else "expired"
            results.append((label, "expire", status, len(removed)))
        return results

    results = [row for rows in together(spark, maintained, targets) for row in rows]
    return spark.createDataFrame(results, RESULT_SCHEMA)
