"""Telemetry view over the generic ``events`` table of the test data.

The table has no devices or sensors, so they are derived from its columns; the
null, corrupt and duplicate rules give every cleaning step something to do.
Every row of the table is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telestrata.schema import TELEMETRY_COLUMNS

JSON_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def telemetry_base(events: DataFrame) -> DataFrame:
    """One telemetry row per event, with ingestion columns."""
    return events.selectExpr(
        "CASE WHEN event_id % 53 <> 0 "
        "THEN concat('device-', lpad(string(user_id), 4, '0')) END AS device_id",
        "ts AS timestamp",
        "CASE WHEN event_type <> 'signup' THEN value - 60.0D END AS temperature",
        "CASE WHEN event_id % 11 <> 0 THEN value - 20.0D END AS humidity",
        "880.0D + value AS pressure",
        "CASE WHEN event_id % 13 <> 0 "
        "THEN double(get_json_object(props, '$.k')) END AS battery_level",
        "event_type AS location",
        "CASE WHEN event_type <> 'error' THEN '1.0.0' END AS firmware_version",
        "CASE WHEN event_id % 97 = 0 "
        "THEN concat('not json ', string(event_id)) END AS _corrupt_record",
        "ts + make_dt_interval(0, 0, 0, event_id % 600) AS _ingested_at",
        "concat('landing/', string(date(ts))) AS _source_file",
        # Every tenth event was sent twice.
        "CASE WHEN event_id % 10 = 0 THEN array(0, 1) ELSE array(0) END AS _copies",
    )


def bronze_from_events(events: DataFrame) -> DataFrame:
    """The 11 Bronze columns, resent events included, from a single scan."""
    base = telemetry_base(events)
    return base.withColumn("_copy", F.explode("_copies")).drop("_copies", "_copy")


def replayed_stamp() -> Column:
    """A Silver stamp that depends on the row, not on the clock."""
    return F.expr("_ingested_at + make_dt_interval(0, 0, 0, second(timestamp) + 1)")


def landing_lines(bronze: DataFrame) -> DataFrame:
    """Bronze rows as the JSON text lines a device would have sent."""
    line = F.to_json(
        F.struct(*TELEMETRY_COLUMNS), {"timestampNTZFormat": JSON_TIME_FORMAT}
    )
    return bronze.select(F.coalesce("_corrupt_record", line).alias("value"))
