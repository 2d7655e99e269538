"""Sessions: stretches of readings of a device without a longer gap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000
DEFAULT_GAP_SECONDS = 1800


def _measures(flag: Column, quality: Column) -> dict[str, Column]:
    """What partial sessions carry; all of it adds up."""
    return {
        "event_count": F.count(F.lit(1)),
        "anomaly_count": F.count_if(flag),
        # Scores have four decimal places, so whole numbers keep the sum exact.
        "quality_units": F.sum(F.round(quality * 10_000).cast("long")),
        "quality_count": F.count(quality),
        "first_seen": F.min("timestamp"),
        "last_seen": F.max("timestamp"),
    }


def _projected(rows: DataFrame) -> DataFrame:
    quality = F.col("quality_units") / (F.col("quality_count") * 10_000)
    return rows.select(
        "device_id",
        F.col("first_seen").alias("session_start"),
        F.col("last_seen").alias("session_end"),
        "event_count",
        "anomaly_count",
        F.when(F.col("quality_count") > 0, F.round(quality, 4)).alias("avg_quality"),
    )


def device_sessions(silver: DataFrame, gap_seconds: int = DEFAULT_GAP_SECONDS) -> DataFrame:
    """One row per session: readings of a device that follow each other within the gap.

    Readings of one time slot as long as the gap always share a session, so slots are
    aggregated first, with a partial step before the shuffle. What is then put in order for each
    device are its slots, not its readings: their number depends on the time covered alone, and
    a device with a third of all rows is no hot key. A reading exactly one gap after another
    still belongs to its session. Rows without a time are left out.
    """
    gap = gap_seconds * MICROS
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    slots = (
        silver.where("timestamp is not null and device_id is not null")
        .groupBy("device_id", F.floor(at / gap).alias("slot"))
        .agg(*[m.alias(n) for n, m in _measures(F.col("_is_anomaly"), F.col("_quality_score")).items()])
    )
    in_order = Window.partitionBy("device_id").orderBy("slot")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    apart = micros("first_seen") - F.lag(micros("last_seen")).over(in_order)
    begins = F.when(apart <= gap, 0).otherwise(1)
    numbered = slots.withColumn("begins", begins).withColumn("number", F.sum("begins").over(in_order))
    merged = numbered.groupBy("device_id", "number").agg(
        *[F.sum(c).alias(c) for c in ("event_count", "anomaly_count", "quality_units", "quality_count")],
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
    return _projected(merged)


def device_sessions_stream(
    silver: DataFrame, gap_seconds: int = DEFAULT_GAP_SECONDS, delay: str = "24 hours"
) -> DataFrame:
    """The same sessions of a stream, each once the watermark has passed its end.

    The built-in session window keeps one row of state per open session. Its sessions end one
    gap after the last reading, the end excluded, so the window is a microsecond longer.
    """
    gap = f"{gap_seconds * MICROS + 1} microseconds"
    windows = silver.where("timestamp is not null and device_id is not null").withWatermark("timestamp", delay)
    grouped = windows.groupBy(F.session_window("timestamp", gap), "device_id")
    measures = _measures(F.col("_is_anomaly"), F.col("_quality_score"))
    return _projected(grouped.agg(*[m.alias(n) for n, m in measures.items()]))
