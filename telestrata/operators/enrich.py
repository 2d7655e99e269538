"""Row-level derivations of the Silver layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telestrata.functions import outside, whole_seconds_between
from telestrata.settings import Settings

Config = Settings | Mapping | None


def normalize_units(df: DataFrame, null_safe: bool = False) -> DataFrame:
    """Clamp humidity to 0..100.

    ``least`` and ``greatest`` skip nulls, so a missing humidity becomes 100 by
    default; ``null_safe=True`` keeps it missing.
    """
    clamped = "greatest(0.0D, least(humidity, 100.0D))"
    if null_safe:
        clamped = f"CASE WHEN humidity IS NOT NULL THEN {clamped} END"
    return df.withColumn("humidity", F.expr(clamped))


def tag_anomalies(df: DataFrame, config: Config = None) -> DataFrame:
    """Per-sensor range flags, their three-valued OR, and the joined reasons."""
    sensors = Settings.of(config).sensors
    flagged = df.withColumns({s.flag: outside(s.column, s.low, s.high) for s in sensors})
    reasons = ", ".join(f"CASE WHEN {s.flag} THEN '{s.reason}' END" for s in sensors)
    return flagged.withColumns(
        {
            "_is_anomaly": F.expr(" OR ".join(s.flag for s in sensors)),
            "_anomaly_details": F.expr(f"nullif(concat_ws(', ', {reasons}), '')"),
        }
    )


def add_zscores(df: DataFrame, config: Config = None) -> DataFrame:
    """Distance from the expected mean in expected deviations, two decimals."""
    return df.withColumns(
        {
            s.zscore: F.expr(f"round(try_divide({s.column} - {s.mean!r}D, {s.stddev!r}D), 2)")
            for s in Settings.of(config).sensors
        }
    )


def add_quality_score(df: DataFrame, config: Config = None) -> DataFrame:
    """Share of filled optional fields, reduced when the row is anomalous."""
    settings = Settings.of(config)
    fields = settings.optional_fields
    filled = " + ".join(f"int(`{c}` IS NOT NULL)" for c in fields)
    factor = f"CASE WHEN _is_anomaly THEN {float(settings.anomaly_penalty)!r}D ELSE 1.0D END"
    score = F.expr(f"round(double({filled}) / {len(fields)} * {factor}, 4)")
    return df.withColumn("_quality_score", score)


def only_anomalies(df: DataFrame) -> DataFrame:
    return df.where(F.col("_is_anomaly"))


def only_clean(df: DataFrame) -> DataFrame:
    """Rows known to be clean; a row with an undecided flag is in neither slice."""
    return df.where(~F.col("_is_anomaly"))


def with_prefix(df: DataFrame, prefix: str, column: str = "device_id") -> DataFrame:
    """Rows whose ``column`` begins with ``prefix``; the filter reaches the scan."""
    return df.where(F.col(column).startswith(prefix))


def processing_latency(silver: DataFrame) -> DataFrame:
    """Seconds from ingestion to the Silver stamp, one row per record."""
    return silver.select(
        "device_id",
        "_ingested_at",
        "_processed_at",
        whole_seconds_between("_ingested_at", "_processed_at").alias("_latency_sec"),
        "_quality_score",
        "_is_anomaly",
    )
