"""Gold tables: one row per device and tumbling time window.

All four tables are projections of one wide aggregate that holds unrounded
values. Built alone, a table reads only what it projects, because Catalyst drops
the unused aggregates; built together they share one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telestrata.functions import exact_mean_sql
from telestrata.settings import Settings

Config = Settings | Mapping | None
KEYS = ("device_id", "window_start", "window_end")
BATTERY = (("avg", "mean"), ("min", "min"), ("max", "max"))
RATE = "try_divide(double(any_n), n)"


def window_stats(
    silver: DataFrame, window: str | None = None, config: Config = None
) -> DataFrame:
    """Wide unrounded aggregate per ``(device_id, window)``."""
    settings = Settings.of(config)
    duration = window or settings.window_duration
    measures = ["count(1) AS n", "count_if(_is_anomaly) AS any_n"]
    for s in settings.sensors:
        distance = f"abs({s.zscore})"
        measures += [
            f"avg({s.column}) AS {s.short}_mean",
            f"stddev({s.column}) AS {s.short}_sd",
            f"min({s.column}) AS {s.short}_min",
            f"max({s.column}) AS {s.short}_max",
            f"count_if({s.flag}) AS {s.short}_n",
            f"{exact_mean_sql(distance, 2)} AS {s.short}_z_mean",
            f"max({distance}) AS {s.short}_z_max",
        ]
    measures += [f"{m}(battery_level) AS battery_{f}" for m, f in BATTERY]
    measures += [
        f"{exact_mean_sql('_quality_score', 4)} AS quality_mean",
        "min(_quality_score) AS quality_min",
    ]
    measures = [F.expr(m) for m in measures]
    bucket = F.window("timestamp", duration)
    if silver.isStreaming:
        # The watermark travels on the window struct, so a stream groups by it.
        grouped = silver.groupBy("device_id", bucket.alias("window")).agg(*measures)
        return grouped.select(
            "device_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *[c for c in grouped.columns if c not in ("device_id", "window")],
        )
    # A batch groups by the start alone: the key is narrower, and a later join on
    # (device_id, window_start) finds the data already partitioned.
    keyed = silver.withColumn("window_start", bucket["start"])
    grouped = keyed.groupBy("device_id", "window_start").agg(*measures)
    # A start lies in its own window, so this is that window's end in any time zone.
    end = F.window("window_start", duration)["end"]
    return grouped.select(
        "device_id",
        "window_start",
        end.alias("window_end"),
        *grouped.columns[2:],
    )


def project_device_summary(stats: DataFrame) -> DataFrame:
    means = {
        "avg_temperature": "temp_mean",
        "stddev_temperature": "temp_sd",
        "min_temperature": "temp_min",
        "max_temperature": "temp_max",
        "avg_humidity": "hum_mean",
        "avg_pressure": "pres_mean",
        "avg_battery_level": "battery_mean",
    }
    return stats.selectExpr(
        *KEYS,
        "n AS event_count",
        *[f"round({value}, 2) AS {name}" for name, value in means.items()],
        "any_n AS anomaly_count",
        f"round({RATE}, 4) AS anomaly_rate",
        "round(quality_mean, 4) AS avg_quality_score",
    )


def project_anomaly_summary(stats: DataFrame, config: Config = None) -> DataFrame:
    return stats.selectExpr(
        *KEYS,
        "n AS total_events",
        *[f"{s.short}_n AS {s.label}_anomaly_count" for s in Settings.of(config).sensors],
        "any_n AS total_anomaly_count",
        f"round({RATE}, 4) AS anomaly_rate",
    )


def project_device_health(stats: DataFrame, config: Config = None) -> DataFrame:
    """Weighted score from unrounded parts; the tier follows the rounded score.

    Without any battery reading the score is null and the tier ``critical``.
    """
    settings = Settings.of(config)
    quality, anomaly, battery = (
        f"{float(w)!r}D"
        for w in (settings.quality_weight, settings.anomaly_weight, settings.battery_weight)
    )
    score = (
        f"{quality} * quality_mean + {anomaly} * (1.0D - {RATE}) "
        f"+ {battery} * (battery_mean / 100.0D)"
    )
    scored = stats.selectExpr(
        *KEYS,
        "n AS event_count",
        "round(quality_mean, 4) AS avg_quality_score",
        f"round({RATE}, 4) AS anomaly_rate",
        "round(battery_mean, 2) AS avg_battery_level",
        f"round({score}, 4) AS health_score",
    )
    return scored.withColumn("risk_tier", risk_tier("health_score", settings))


def risk_tier(score: str, settings: Settings) -> Column:
    return F.expr(
        f"CASE WHEN {score} >= {float(settings.healthy_from)!r}D THEN 'healthy' "
        f"WHEN {score} >= {float(settings.warning_from)!r}D THEN 'warning' "
        "ELSE 'critical' END"
    )


def project_ml_features(stats: DataFrame, config: Config = None) -> DataFrame:
    sensors = Settings.of(config).sensors
    columns = ["n AS event_count"]
    for p in (s.short for s in sensors):
        columns += [
            f"round({p}_mean, 4) AS {p}_mean",
            f"round({p}_sd, 4) AS {p}_stddev",
            f"round({p}_min, 4) AS {p}_min",
            f"round({p}_max, 4) AS {p}_max",
            f"round(round({p}_max, 4) - round({p}_min, 4), 4) AS {p}_range",
        ]
    columns += [f"round(battery_{f}, 4) AS battery_{f}" for _, f in BATTERY]
    columns += ["any_n AS anomaly_count", f"round({RATE}, 4) AS anomaly_rate"]
    columns += [f"{s.short}_n AS {s.short}_anomaly_count" for s in sensors]
    columns += [f"round(quality_{f}, 4) AS quality_{f}" for f in ("mean", "min")]
    columns += [
        f"round({s.short}_z_{f}, 4) AS {s.short}_zscore_abs_{f}"
        for s in sensors
        for f in ("mean", "max")
    ]
    return stats.selectExpr(*KEYS, *columns)


def compute_device_summary(
    silver: DataFrame, window: str | None = None, config: Config = None
) -> DataFrame:
    return project_device_summary(window_stats(silver, window, config))


def compute_anomaly_summary(
    silver: DataFrame, window: str | None = None, config: Config = None
) -> DataFrame:
    return project_anomaly_summary(window_stats(silver, window, config), config)


def compute_device_health(
    silver: DataFrame, config: Config = None, window: str | None = None
) -> DataFrame:
    return project_device_health(window_stats(silver, window, config), config)


def compute_ml_features(
    silver: DataFrame, window: str | None = None, config: Config = None
) -> DataFrame:
    return project_ml_features(window_stats(silver, window, config), config)


GOLD_TABLES = {
    "device_summary": lambda stats, settings: project_device_summary(stats),
    "anomaly_summary": project_anomaly_summary,
    "device_health": project_device_health,
    "ml_features": project_ml_features,
}
