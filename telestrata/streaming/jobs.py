"""The three streaming steps: landing to Bronze, Bronze to Silver, Silver to Gold."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from telestrata.operators.windows import compute_device_summary
from telestrata.plans.silver import apply_transformations
from telestrata.schema import BRONZE_SCHEMA
from telestrata.settings import Settings
from telestrata.sources.landing import add_ingestion_metadata, read_raw_stream
from telestrata.sources.batches import read_batch_stream
from telestrata.streaming.sinks import append_stream, batch_stream

Config = Settings | Mapping | None


def read_table_stream(
    spark: SparkSession, path: str, schema: StructType, config: Config = None
) -> DataFrame:
    limit = Settings.of(config).max_files_per_trigger
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", limit).parquet(path)
    )


def start_bronze(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    config: Config = None,
    drain: bool = False,
    by_batch: bool = False,
) -> StreamingQuery:
    """Keep everything that arrives, corrupt or late, with ingestion columns.

    ``by_batch`` writes a batch layer, which can be maintained in place.
    """
    settings = Settings.of(config)
    raw = add_ingestion_metadata(read_raw_stream(spark, landing, settings))
    sink = batch_stream if by_batch else append_stream
    return sink(raw, bronze, checkpoint, settings, "bronze", drain)


def start_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    checkpoint: str,
    config: Config = None,
    drain: bool = False,
    by_date: bool = True,
    salts: int = 0,
    by_batch: bool = False,
) -> StreamingQuery:
    """Clean and deduplicate within the watermark; later rows are discarded.

    ``by_batch`` reads and writes batch layers, which can be maintained in place.
    """
    settings = Settings.of(config)
    if by_batch:
        source = read_batch_stream(spark, bronze, BRONZE_SCHEMA, settings.max_files_per_trigger)
    else:
        source = read_table_stream(spark, bronze, BRONZE_SCHEMA, settings)
    cleaned = apply_transformations(source, settings, salts=salts)
    sink = batch_stream if by_batch else append_stream
    return sink(cleaned, silver, checkpoint, settings, "silver", drain, by_date)


def start_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    checkpoint: str,
    config: Config = None,
    drain: bool = False,
) -> StreamingQuery:
    """Device summary of the windows that the watermark has closed."""
    settings = Settings.of(config)
    schema = spark.read.option("mergeSchema", "true").parquet(silver).schema
    source = read_table_stream(spark, silver, schema, settings)
    summary = compute_device_summary(
        source.withWatermark("timestamp", settings.watermark), settings.window_duration
    )
    return append_stream(summary, gold, checkpoint, settings, "gold", drain)
