"""Joins in time: the last row before, and the intervals around."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000


def micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    slice_seconds: int = 3600,
) -> DataFrame:
    """``left`` with ``columns`` of the last row of ``right`` of its key, not later than it.

    Time is cut into slices. Within one key and slice the rows of both sides are put in order,
    and the last right row is carried forward; what a slice inherits comes from a second pass
    over one row per key and slice. No sort covers more than a slice of a key, so a key with a
    third of all rows is spread over its slices. Every left row stays, also without a partner,
    key or time. Of right rows with equal times the one with the largest ``columns`` counts.
    Columns of ``left`` with such a name are replaced.
    """
    length = slice_seconds * MICROS
    value = F.struct(*[F.col(c) for c in columns])
    kept = [c for c in left.columns if c not in columns]
    mine = left.select(
        F.col(on).alias("k"), micros(left_time).alias("t"), F.lit(2).alias("side"),
        F.struct(*[F.col(c) for c in kept]).alias("row"),
    )
    theirs = right.where(F.col(on).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(on).alias("k"), micros(right_time).alias("t"), value.alias("value")
    )
    cell = F.floor(F.col("t") / length).alias("slice")
    # The last value of each slice, and what the slices after it inherit.
    ends = theirs.groupBy("k", cell).agg(F.max(F.struct("t", "value"))["value"].alias("last"))
    wanted = mine.where("k is not null and t is not null").select("k", cell).distinct()
    before = Window.partitionBy("k").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    cells = ends.join(wanted.withColumn("wanted", F.lit(True)), ["k", "slice"], "full_outer")
    inherited = cells.withColumn("value", F.last("last", ignorenulls=True).over(before)).where("wanted and value is not null")
    union = (
        mine.withColumn("slice", F.floor(F.col("t") / length))
        .unionByName(theirs.withColumn("slice", F.floor(F.col("t") / length)).withColumn("side", F.lit(1)), True)
        .unionByName(
            inherited.select("k", "slice", (F.col("slice") * length).alias("t"), F.lit(0).alias("side"), "value"), True
        )
    )
    upto = Window.partitionBy("k", "slice").orderBy("t", "side", "value").rowsBetween(Window.unboundedPreceding, 0)
    known = F.when(F.col("k").isNotNull() & F.col("t").isNotNull(), F.last("value", ignorenulls=True).over(upto))
    matched = union.withColumn("found", known).where("side = 2")
    return matched.select("row.*", *[F.col("found")[c].alias(c) for c in columns])


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: str,
    time: str,
    start: str,
    end: str,
    columns: Sequence[str],
    base_seconds: int = 300,
) -> DataFrame:
    """``points`` with ``columns`` of each interval of their key with ``start <= time < end``.

    An inner join on bins of time. An interval belongs to the level whose bins are at least as
    long as it (each level doubles the length), so it meets two bins at most; a point looks up
    one bin on every level that occurs, about twenty for intervals from minutes to years. Bins are
    part of the join key, which spreads a hot key over time, and the exact bounds are checked
    inside the join. Empty intervals, and rows without key or time, have no partner.
    """
    base = base_seconds * MICROS
    low, high = micros(start), micros(end)
    level = F.greatest(F.lit(0), F.ceil(F.log2((high - low) / base))).cast("int")
    shifted = intervals.where((low < high) & F.col(on).isNotNull()).select(
        F.col(on).alias("_k"), low.alias("_low"), high.alias("_high"), level.alias("_level"),
        F.struct(*[F.col(c) for c in columns]).alias("_value"),
    )
    size = F.lit(base) * F.pow(F.lit(2), F.col("_level")).cast("long")
    bins = F.sequence(F.floor(F.col("_low") / size), F.floor((F.col("_high") - 1) / size))
    placed = shifted.withColumn("_bin", F.explode(bins))
    # One row of at most 64 levels.
    levels = shifted.agg(F.array_sort(F.collect_set("_level")).alias("_levels"))
    looked = points.where(F.col(on).isNotNull()).withColumn("_t", micros(time)).where("_t is not null")
    looked = looked.crossJoin(F.broadcast(levels)).withColumn("_level", F.explode("_levels"))
    looked = looked.withColumn("_bin", F.floor(F.col("_t") / size))
    found = looked.join(
        placed.withColumnsRenamed({"_level": "_l", "_bin": "_b"}),
        (F.col(on) == F.col("_k")) & (F.col("_level") == F.col("_l")) & (F.col("_bin") == F.col("_b"))
        & (F.col("_low") <= F.col("_t")) & (F.col("_t") < F.col("_high")),
    )
    kept = [c for c in points.columns if c not in columns]
    return found.select(*kept, *[F.col("_value")[c].alias(c) for c in columns])
