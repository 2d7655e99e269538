"""Raw telemetry: newline-delimited JSON with a fixed schema.

A record that does not parse, or holds a value of the wrong type, keeps its text
in ``_corrupt_record``. Fields outside the schema are ignored, or kept as a variant on request.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telestrata.schema import CORRUPT_COLUMN, RAW_SCHEMA, TELEMETRY_COLUMNS
from telestrata.settings import Settings

PARSER = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Batch read. Spark refuses to read the corrupt column alone from raw JSON,
    so write Bronze first and query that."""
    return spark.read.schema(RAW_SCHEMA).options(**PARSER).json(path)


def read_raw_stream(
    spark: SparkSession, path: str, config: Settings | Mapping | None = None
) -> DataFrame:
    limit = Settings.of(config).max_files_per_trigger
    return (
        spark.readStream.schema(RAW_SCHEMA)
        .options(**PARSER)
        .option("maxFilesPerTrigger", limit)
        .json(path)
    )


def parse_lines(lines: DataFrame, column: str = "value", rescued: str | None = None) -> DataFrame:
    """The same parse for text that is already in a column.

    ``rescued`` names a variant column for the fields that the schema doesn't know, with their
    types and nested values, to be read by path (``variant_get``). It is null where there are
    none and where the line isn't an object. Streams of text parse the same way.
    """
    record = F.from_json(column, RAW_SCHEMA, PARSER).alias("record")
    if rescued is None:
        return lines.select(record).select("record.*")
    known = F.array(*map(F.lit, TELEMETRY_COLUMNS))
    parsed = lines.select(record, F.from_json(column, "map<string, variant>").alias("fields"))
    unknown = F.map_filter("fields", lambda name, _: ~F.array_contains(known, name))
    return parsed.select("record.*", unknown.alias("fields")).select(
        *RAW_SCHEMA.names, F.when(F.size("fields") > 0, F.to_variant_object("fields")).alias(rescued)
    )


def add_ingestion_metadata(df: DataFrame) -> DataFrame:
    """Stamp each row of a file source with the clock and its file."""
    return df.select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_source_file"),
    )
