"""Bronze to Silver as one chain of transforms, for batch frames and streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telestrata.operators import cleaning, enrich
from telestrata.settings import Settings


def apply_transformations(
    df: DataFrame,
    config: Settings | Mapping | None = None,
    processed_at: Column | None = None,
    null_safe: bool = False,
    salts: int = 0,
) -> DataFrame:
    """Filters run before the deduplication shuffle, derivations after it.

    ``processed_at`` replaces the clock reading, for reproducible backfills.
    """
    settings = Settings.of(config)
    stamp = F.current_timestamp() if processed_at is None else processed_at
    if df.isStreaming:
        df = df.withWatermark("timestamp", settings.watermark)
    return (
        df.transform(cleaning.drop_corrupt_records)
        .transform(cleaning.drop_nulls)
        .transform(cleaning.enforce_schema)
        .transform(cleaning.deduplicate, salts=salts)
        .transform(enrich.normalize_units, null_safe)
        .transform(enrich.tag_anomalies, settings)
        .transform(enrich.add_zscores, settings)
        .transform(enrich.add_quality_score, settings)
        .withColumn("_processed_at", stamp)
    )
