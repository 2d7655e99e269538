"""Device health rankings, rollups and decompositions over the Gold tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telestrata.functions import exact_mean, ratio
from telestrata.operators.distributions import median_whole_number
from telestrata.settings import TIERS, Settings

Config = Settings | Mapping | None


def top_windows(device_summary: DataFrame, k: int = 20) -> DataFrame:
    """Device windows with the most events."""
    return device_summary.orderBy(
        F.desc("event_count"), "device_id", "window_start"
    ).limit(k)


def top_anomaly_rate(device_rates: DataFrame, k: int = 20) -> DataFrame:
    return device_rates.orderBy(F.desc_nulls_last("anomaly_rate"), "device_id").limit(k)


def top_abs_z(device_z: DataFrame, k: int = 20, by: str = "temperature") -> DataFrame:
    return device_z.orderBy(F.desc_nulls_last(f"avg_abs_{by}_z"), "device_id").limit(k)


def lowest_health(
    device_health: DataFrame, k: int = 10, config: Config = None
) -> DataFrame:
    """The windows that need attention first, with what makes up their score."""
    lowest = device_health.orderBy(
        F.asc_nulls_last("health_score"), "device_id", "window_start"
    ).limit(k)
    return lowest.withColumns(
        health_components(
            F.col("avg_quality_score"),
            F.col("anomaly_rate"),
            F.col("avg_battery_level"),
            config,
        )
    )


def health_components(
    quality: Column, anomaly_rate: Column, battery: Column, config: Config = None
) -> dict[str, Column]:
    settings = Settings.of(config)
    return {
        "quality_component": F.round(settings.quality_weight * quality, 6),
        "anomaly_component": F.round(settings.anomaly_weight * (1.0 - anomaly_rate), 6),
        "battery_component": F.round(settings.battery_weight * (battery / 100.0), 6),
    }


def most_common_tier() -> Column:
    """Mode of ``risk_tier``; the alphabetically first tier wins a tie.

    With three known tiers, counters keep the aggregate a plain hash aggregate
    of fixed width, which a generic mode (a map per group) is not.
    """
    tiers = sorted(TIERS)
    counts = {t: F.count_if(F.col("risk_tier") == t) for t in tiers}
    most = F.greatest(*counts.values())
    chosen = F.when(most == 0, F.lit(None).cast("string"))
    for tier in tiers:
        chosen = chosen.when(counts[tier] == most, tier)
    return chosen


def device_rollup(device_health: DataFrame) -> DataFrame:
    """Health of each device over all its windows."""
    return device_health.groupBy("device_id").agg(
        exact_mean("health_score", 4).alias("avg_health"),
        F.min("health_score").alias("min_health"),
        exact_mean("anomaly_rate", 4).alias("avg_anomaly_rate"),
        exact_mean("avg_battery_level", 2).alias("avg_battery"),
        exact_mean("avg_quality_score", 4).alias("avg_quality"),
        most_common_tier().alias("risk_tier"),
    )


def ranked_devices(rollup: DataFrame) -> DataFrame:
    """All devices, least healthy first."""
    return rollup.orderBy(F.asc_nulls_last("avg_health"), "device_id")


def health_decomposition(
    rollup: DataFrame, k: int = 10, config: Config = None
) -> DataFrame:
    """Weighted components of the ``k`` least healthy devices.

    The mean quality that explains a score comes from the rollup itself, so it
    needs no second aggregate and no lookup join.
    """
    at_risk = ranked_devices(rollup).limit(k)
    return at_risk.select(
        "device_id",
        "avg_health",
        "risk_tier",
        *[
            c.alias(name)
            for name, c in health_components(
                F.col("avg_quality"),
                F.col("avg_anomaly_rate"),
                F.col("avg_battery"),
                config,
            ).items()
        ],
    )


def health_trend(device_health: DataFrame, k: int = 5) -> DataFrame:
    """Health over time of the ``k`` least healthy devices."""
    # The join would add this filter to one side only; on both sides, Spark
    # computes the table once.
    device_health = device_health.where(F.col("device_id").isNotNull())
    spotlight = ranked_devices(device_rollup(device_health)).limit(k).select("device_id")
    # The broadcast side has k rows by construction.
    series = device_health.join(F.broadcast(spotlight), "device_id", "left_semi")
    return series.select(
        "device_id", "window_start", "health_score", "risk_tier"
    ).orderBy("device_id", "window_start")


def risk_tiers(device_health: DataFrame) -> DataFrame:
    """Windows per tier and their share; the window runs over one row per tier."""
    counts = device_health.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("risk_tier", "n", ratio(F.col("n"), total).alias("share"))


def health_stats(device_health: DataFrame) -> DataFrame:
    return device_health.agg(
        exact_mean("health_score", 4).alias("mean_health"),
        F.min("health_score").alias("min_health"),
        F.max("health_score").alias("max_health"),
    )


def kpis(
    anomaly_summary: DataFrame, device_health: DataFrame, latency: DataFrame
) -> DataFrame:
    """Headline figures, long form ``(kpi, value)``; one pass per table."""
    anomalies = anomaly_summary.agg(
        F.sum("total_anomaly_count").cast("double").alias("total_anomalies")
    )
    health = device_health.agg(
        exact_mean("health_score", 4).alias("avg_health"),
        F.count_if(F.col("risk_tier") == "critical").cast("double").alias("critical_windows"),
    )
    wait = median_whole_number(latency, "_latency_sec").select(
        F.col("median").alias("median_latency_sec")
    )
    return (
        anomalies.unpivot([], ["total_anomalies"], "kpi", "value")
        .unionByName(health.unpivot([], ["avg_health", "critical_windows"], "kpi", "value"))
        .unionByName(wait.unpivot([], ["median_latency_sec"], "kpi", "value"))
    )


def join_features_health(
    features: DataFrame,
    device_health: DataFrame,
    on: Sequence[str] = ("device_id", "window_start"),
) -> DataFrame:
    """Features with the health of the same device window, unmatched ones kept.

    Both tables are grouped by the default key, so the join adds no shuffle and
    no fan-out. ``on=["device_id"]`` pairs each feature window with every health
    window of the device.
    """
    right = device_health.select(*on, "health_score", "risk_tier")
    return features.join(right, list(on), "left")
