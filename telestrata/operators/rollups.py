"""Subtotals over several dimensions in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telestrata.functions import ratio


def with_tiers(silver: DataFrame, device_health: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Events, anomalies and quality of Silver by ``dimensions`` and the tier of their window.

    Silver is aggregated by window first, which is how health is grouped, so the join meets
    aggregated rows on the key that both sides are partitioned by.
    """
    start = F.window("timestamp", "1 hour")["start"].alias("window_start")
    fine = silver.groupBy("device_id", start, *dimensions).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("_is_anomaly").alias("anomalies"),
        F.sum(F.round(F.col("_quality_score") * 10_000).cast("bigint")).alias("quality"),
    )
    tiers = device_health.select("device_id", "window_start", "risk_tier")
    return fine.join(tiers, ["device_id", "window_start"])


def subtotals(
    rows: DataFrame, dimensions: Sequence[str], sets: Sequence[Sequence[str]] | None = None
) -> DataFrame:
    """All subtotals of ``with_tiers`` (or those of ``sets``), told apart by ``level``.

    Grouping sets multiply rows, so the rows are added up to the finest level first; what is
    multiplied has one row per combination that occurs. ``level`` has a bit for each dimension
    that is left out, the last one lowest; a null dimension whose bit is 0 is a null of the data.
    """
    names = list(dimensions)
    finest = rows.groupBy(*names).agg(*[F.sum(c).alias(c) for c in ("events", "anomalies", "quality")])
    if sets is None:
        grouped = finest.cube(*names)
    else:
        grouped = finest.groupingSets([[F.col(c) for c in one] for one in sets], *[F.col(c) for c in names])
    added = grouped.agg(
        F.grouping_id().alias("level"),
        *[F.sum(c).alias(c) for c in ("events", "anomalies", "quality")],
    )
    return added.select(
        *names,
        "level",
        "events",
        "anomalies",
        F.round(ratio(F.col("anomalies"), F.col("events")), 4).alias("anomaly_rate"),
        F.round(ratio(F.col("quality"), F.col("events") * 10_000), 4).alias("avg_quality"),
    )
