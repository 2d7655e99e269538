"""Reading the stored layers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DATE_COLUMN = "event_date"


def read_layer(
    spark: SparkSession,
    path: str,
    since: str | None = None,
    until: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """A stored layer, optionally only ``since <= timestamp < until``.

    On a table partitioned by event date the bounds also select the partitions. Without a
    schema, the columns of all files are merged, so one that came later doesn't vanish.
    """
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    df = reader.parquet(path)
    dated = DATE_COLUMN in df.columns
    if since is not None:
        bound = F.lit(since).cast("timestamp")
        df = df.where(F.col("timestamp") >= bound)
        if dated:
            df = df.where(F.col(DATE_COLUMN) >= F.to_date(bound))
    if until is not None:
        bound = F.lit(until).cast("timestamp")
        df = df.where(F.col("timestamp") < bound)
        if dated:
            df = df.where(F.col(DATE_COLUMN) <= F.to_date(bound))
    return df.drop(DATE_COLUMN)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored layer, or no rows of the given schema while it does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
