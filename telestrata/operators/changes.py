"""What differs between two tables or two versions of one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _both(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both sides, told apart by ``_side``; a column of one side is null in the other."""
    return old.withColumn("_side", F.lit(-1)).unionByName(new.withColumn("_side", F.lit(1)), True)


def row_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that one side holds more often: ``change``, ``copies`` and the columns.

    Equal rows cancel inside each partition before the shuffle, so a row with very many copies
    is no hot key. Nulls equal nulls.
    """
    both = _both(old, new)
    columns = [c for c in both.columns if c != "_side"]
    balance = both.groupBy(*columns).agg(F.sum("_side").alias("_n")).where("_n <> 0")
    change = F.when(F.col("_n") > 0, "added").otherwise("removed")
    return balance.select(change.alias("change"), F.abs("_n").alias("copies"), *columns)


def keyed_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that were added, removed or changed, with the names of the columns that changed.

    Both sides meet in one aggregate on the keys. Keys are meant to be unique on each side; of a
    repeated one the largest row is compared. Null keys equal each other.
    """
    both = _both(old, new)
    rest = [c for c in both.columns if c not in (*keys, "_side")]
    row = F.struct(*rest)
    sides = both.groupBy(*keys).agg(
        F.max(F.when(F.col("_side") < 0, row)).alias("o"), F.max(F.when(F.col("_side") > 0, row)).alias("n")
    )
    differs = [F.when(~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")), F.lit(c)) for c in rest]
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").otherwise("changed")
    changed = F.when(change == "changed", F.array_compact(F.array(*differs)))
    return (
        sides.select(*keys, change.alias("change"), changed.alias("changed_columns"))
        .where("change <> 'changed' or size(changed_columns) > 0")
    )
