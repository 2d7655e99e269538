"""Whole-table profiles, per-device rates and series over Bronze and Silver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telestrata.functions import exact_mean, flag_count, ratio
from telestrata.settings import Settings

Config = Settings | Mapping | None


def bronze_profile(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("_corrupt_record").alias("corrupt_records"),
        F.count_distinct("device_id").alias("distinct_devices"),
        F.count_distinct("_source_file").alias("source_files"),
        F.min("_ingested_at").alias("earliest_ingestion"),
        F.max("_ingested_at").alias("latest_ingestion"),
    )


def numeric_ranges(df: DataFrame) -> DataFrame:
    """Smallest, largest and mean reading of every sensor, in one row."""
    names = {
        "temp": "temperature",
        "hum": "humidity",
        "pres": "pressure",
        "batt": "battery_level",
    }
    measures = []
    for short, column in names.items():
        measures += [
            F.min(column).alias(f"{short}_min"),
            F.max(column).alias(f"{short}_max"),
            F.avg(column).alias(f"{short}_avg"),
        ]
    return df.agg(*measures)


def silver_profile(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("device_id").alias("distinct_devices"),
        flag_count("_is_anomaly").alias("anomaly_count"),
        exact_mean("_quality_score", 4).alias("avg_quality_score"),
        F.min("_quality_score").alias("min_quality_score"),
    )


def anomaly_breakdown(silver: DataFrame, config: Config = None) -> DataFrame:
    """Raised flags by sensor and in total."""
    sensors = Settings.of(config).sensors
    return silver.agg(
        *[
            F.sum(F.col(s.flag).cast("int")).alias(f"{s.column}_anomalies")
            for s in sensors
        ],
        F.sum(F.col("_is_anomaly").cast("int")).alias("total_anomalies"),
    )


def layer_funnel(layers: Mapping[str, DataFrame | None]) -> DataFrame:
    """Width and rows per layer, the share of the first layer, and the loss at each
    step.

    A layer given as ``None`` (table missing) counts as 0 rows. The window runs
    over one row per layer.
    """
    counts = None
    for position, (name, df) in enumerate(layers.items()):
        if df is None:
            continue
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(position).alias("position"),
            F.lit(name).alias("layer"),
            F.lit(len(df.columns)).alias("column_count"),
            "row_count",
        )
        counts = one if counts is None else counts.unionByName(one)
    if counts is None:
        raise ValueError("layer_funnel needs at least one existing table")
    missing = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("layer"),
            F.lit(0).alias("column_count"),
            F.lit(0).cast("bigint").alias("row_count"),
        )
        for position, (name, df) in enumerate(layers.items())
        if df is None
    ]
    if missing:
        blanks = counts.sparkSession.range(1).select(F.inline(F.array(*missing)))
        counts = counts.unionByName(blanks)
    steps = Window.orderBy("position")
    first = F.first("row_count").over(steps)
    before = F.coalesce(F.lag("row_count").over(steps), "row_count")
    return counts.select(
        "position",
        "layer",
        "column_count",
        "row_count",
        F.round(ratio(F.col("row_count"), first), 4).alias("share_of_first"),
        (before - F.col("row_count")).alias("rows_dropped"),
        F.round(ratio(before - F.col("row_count"), before), 4).alias("drop_rate"),
    )


def dq_summary(bronze: DataFrame, silver: DataFrame, gold: Mapping[str, DataFrame]) -> DataFrame:
    """Long-form quality figures ``(layer, metric, value)``, one pass per table."""
    no_key = F.col("device_id").isNull() | F.col("timestamp").isNull()
    total, anomalies = F.count(F.lit(1)), flag_count("_is_anomaly")
    parts = [
        _long(
            bronze,
            "bronze",
            {
                "total_records": total,
                "corrupt_records": F.count("_corrupt_record"),
                "null_key_records": F.count_if(no_key),
            },
        ),
        _long(
            silver,
            "silver",
            {
                "clean_records": total - anomalies,
                "anomalous_records": anomalies,
                "avg_quality_score": F.round(exact_mean("_quality_score", 4), 4),
            },
        ),
    ]
    rows = None
    for table in gold.values():
        one = table.agg(total.alias("n"))
        rows = one if rows is None else rows.unionByName(one)
    if rows is not None:
        parts.append(_long(rows, "gold", {"aggregate_rows": F.sum("n")}))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _long(df: DataFrame, layer: str, measures: Mapping) -> DataFrame:
    one_row = df.agg(*[m.cast("double").alias(name) for name, m in measures.items()])
    return one_row.unpivot([], list(measures), "metric", "value").select(
        F.lit(layer).alias("layer"), "metric", "value"
    )


def device_anomaly_rate(silver: DataFrame) -> DataFrame:
    """Events with a decided flag, anomalies and their ratio per device."""
    counted = silver.groupBy("device_id").agg(
        F.count("_is_anomaly").alias("total_events"),
        flag_count("_is_anomaly").alias("anomaly_count"),
    )
    return counted.withColumn(
        "anomaly_rate", ratio(F.col("anomaly_count"), F.col("total_events"))
    )


def anomaly_by_device(anomaly_summary: DataFrame) -> DataFrame:
    """Totals by type for the devices that have any, fewest first."""
    kinds = ("temp", "humidity", "pressure", "total")
    totals = anomaly_summary.groupBy("device_id").agg(
        *[F.sum(f"{k}_anomaly_count").alias(f"{k}_anomaly_count") for k in kinds]
    )
    return totals.where(F.col("total_anomaly_count") > 0).orderBy(
        "total_anomaly_count", "device_id"
    )


def device_abs_z(silver: DataFrame, config: Config = None) -> DataFrame:
    """Mean absolute z-score of each sensor per device."""
    return silver.groupBy("device_id").agg(
        *[
            exact_mean(f"abs({s.zscore})", 2).alias(f"avg_abs_{s.column}_z")
            for s in Settings.of(config).sensors
        ]
    )


def z_rule_agreement(
    silver: DataFrame, config: Config = None, cut: float = 3.0
) -> DataFrame:
    """How often a statistical outlier and a range flag agree, per sensor.

    Undecided values count as "no" on both sides.
    """
    no = F.lit(False)
    per_sensor = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(s.column).alias("sensor"),
                    F.coalesce(F.abs(F.col(s.zscore)) > cut, no).alias("z"),
                    F.coalesce(F.col(s.flag), no).alias("rule"),
                )
                for s in Settings.of(config).sensors
            ]
        )
    )
    z, rule = F.col("z"), F.col("rule")
    return (
        silver.select(per_sensor)
        .groupBy("sensor")
        .agg(
            F.count_if(z & rule).alias("both"),
            F.count_if(z & ~rule).alias("z_only"),
            F.count_if(~z & rule).alias("rule_only"),
            F.count_if(~z & ~rule).alias("neither"),
        )
    )


def anomaly_per_minute(silver: DataFrame) -> DataFrame:
    """Events with a decided flag and anomalies by type for every minute."""
    minute = F.window("timestamp", "1 minute")["start"]
    series = (
        silver.withColumn("minute", minute)
        .groupBy("minute")
        .agg(
            F.count("_is_anomaly").alias("total_events"),
            flag_count("_is_anomaly").alias("anomaly_count"),
            flag_count("_is_temp_anomaly").alias("temp_anom"),
            flag_count("_is_humidity_anomaly").alias("hum_anom"),
            flag_count("_is_pressure_anomaly").alias("pres_anom"),
        )
    )
    return series.withColumn(
        "anomaly_rate", ratio(F.col("anomaly_count"), F.col("total_events"))
    )


def battery_split(silver: DataFrame, cut: float = 30.0) -> DataFrame:
    """Anomaly rate of low and healthy batteries; an unknown level is in neither."""
    level = F.col("battery_level")
    return (
        silver.where(level.isNotNull())
        .withColumn("battery_group", F.when(level < cut, "low").otherwise("healthy"))
        .groupBy("battery_group")
        .agg(
            F.count(F.lit(1)).alias("events"),
            flag_count("_is_anomaly").alias("anomalies"),
            ratio(flag_count("_is_anomaly"), F.count("_is_anomaly")).alias("anomaly_rate"),
        )
    )
