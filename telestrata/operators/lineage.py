"""Column differences between layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_fill(df: DataFrame) -> DataFrame:
    """Filled rows of every column, one row per column, from one pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "filled")


def schema_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns added, dropped and kept between two layers, with their filled rows.

    A layer without the column fills it 0 times.
    """
    sides = [
        column_fill(df).select(
            "column_name",
            F.lit(here).alias("is_after"),
            F.when(~F.lit(here), F.col("filled")).otherwise(0).alias("filled_before"),
            F.when(F.lit(here), F.col("filled")).otherwise(0).alias("filled_after"),
        )
        for here, df in ((False, before), (True, after))
    ]
    change = (
        F.when(F.every("is_after"), "added")
        .when(~F.some("is_after"), "dropped")
        .otherwise("kept")
    )
    return sides[0].unionByName(sides[1]).groupBy("column_name").agg(
        change.alias("change"),
        F.max("filled_before").alias("filled_before"),
        F.max("filled_after").alias("filled_after"),
    )
