"""Fixed schema of the raw telemetry records."""

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

TELEMETRY_FIELDS = (
    ("device_id", T.StringType()),
    ("timestamp", T.TimestampType()),
    ("temperature", T.DoubleType()),
    ("humidity", T.DoubleType()),
    ("pressure", T.DoubleType()),
    ("battery_level", T.DoubleType()),
    ("location", T.StringType()),
    ("firmware_version", T.StringType()),
)
TELEMETRY_COLUMNS = tuple(name for name, _ in TELEMETRY_FIELDS)

# File readers force every field nullable, so a missing key arrives as null and
# is dropped by the Silver layer, not by the reader.
RAW_SCHEMA = T.StructType(
    [T.StructField(n, t, n not in ("device_id", "timestamp")) for n, t in TELEMETRY_FIELDS]
    + [T.StructField(CORRUPT_COLUMN, T.StringType())]
)

BRONZE_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType) for f in RAW_SCHEMA]
    + [
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_source_file", T.StringType()),
    ]
)
