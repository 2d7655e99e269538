"""Row filters between Bronze and Silver; the same code runs on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telestrata.schema import CORRUPT_COLUMN
from telestrata.settings import KEY_COLUMNS

BRONZE_ONLY_COLUMNS = ("_source_file",)


def drop_corrupt_records(df: DataFrame) -> DataFrame:
    """Keep the rows the parser understood; no-op without a corrupt column."""
    if CORRUPT_COLUMN not in df.columns:
        return df
    return df.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)


def drop_nulls(df: DataFrame, required_cols: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Keep the rows that carry every required field."""
    return df.dropna(subset=list(required_cols))


def deduplicate(
    df: DataFrame, key_cols: Sequence[str] = KEY_COLUMNS, salts: int = 0
) -> DataFrame:
    """One row per key; which of several differing rows survives is not defined.

    A batch plan already collapses copies inside each input partition before the
    shuffle. A stream has no such step, so the copies of one key all go to one task.
    For feeds with heavy replays of single keys, ``salts`` adds a first pass keyed on
    ``(key, salt)`` that spreads them over so many tasks, at the price of up to twice
    the state.
    """
    keys = list(key_cols)
    if not (df.isStreaming and salts):
        return df.dropDuplicates(keys)
    salted = df.withColumn("_salt", F.spark_partition_id() % salts)
    return salted.dropDuplicates([*keys, "_salt"]).drop("_salt").dropDuplicates(keys)


def deduplicate_first(
    df: DataFrame,
    key_cols: Sequence[str] = KEY_COLUMNS,
    order_col: str = "_ingested_at",
) -> DataFrame:
    """One row per key: earliest ``order_col``, then the lowest payload.

    ``min`` over a struct is a partial aggregate, so a key with very many copies
    shrinks to one row per input partition before it is shuffled.
    """
    keys = list(key_cols)
    rest = [c for c in df.columns if c not in (*keys, order_col)]
    ordered = F.struct(
        F.col(order_col).isNull().alias("_missing"), order_col, *rest
    )
    first = df.groupBy(*keys).agg(F.min(ordered).alias("_first"))
    return first.select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns]
    )


def enforce_schema(df: DataFrame) -> DataFrame:
    """Drop the columns that only Bronze carries."""
    return df.drop(*BRONZE_ONLY_COLUMNS)
