"""Baselines over the time just before each reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telestrata.operators.temporal import MICROS, micros

WIDE = "decimal(38, 0)"


def rolling_baseline(
    df: DataFrame,
    value: str,
    places: int = 2,
    on: str = "device_id",
    time: str = "timestamp",
    back_seconds: int = 86_400,
    bucket_seconds: int = 3_600,
) -> DataFrame:
    """``df`` with ``baseline_n``, ``baseline_mean``, ``baseline_sd`` and ``baseline_z``.

    The baseline of a row are the readings of its key from ``back_seconds`` before it (included)
    up to its own time (left out). Time is cut into buckets, of which ``back_seconds`` is a
    multiple. Whole buckets come from one row of totals per key and bucket; inside a row's own
    bucket, earlier readings are added and those that have grown too old are taken away again. No
    sort covers more than a bucket of a key and its shifted copy, so a key with a third of all
    rows is spread over its buckets.

    Values are rounded to ``places`` and summed as whole numbers, so adding and taking away is
    exact. Null and NaN values count nowhere and have no z; neither has a row without key or time,
    with fewer than two readings before it, or with equal ones only.
    """
    if back_seconds % bucket_seconds:
        raise ValueError("back_seconds must be a multiple of bucket_seconds")
    scale, length, back = 10**places, bucket_seconds * MICROS, back_seconds * MICROS
    given = F.when(~F.isnan(F.col(value).cast("double")), F.round(F.col(value) * scale).cast("bigint"))
    known = F.col("k").isNotNull() & F.col("t").isNotNull()
    # Rows without key or time have no baseline; their hash keeps them from being one big group.
    spread_out = F.pmod(F.xxhash64(*df.columns), F.lit(4096))
    rows = df.select(
        F.col(on).alias("k"), micros(time).alias("t"), given.alias("x"), F.struct(*df.columns).alias("row"),
        spread_out.alias("h"),
    ).withColumn("bucket", F.when(known, F.floor(F.col("t") / length)).otherwise(F.col("h"))).drop("h")
    counted = rows.where(known & F.col("x").isNotNull())
    square = F.col("x").cast(WIDE) * F.col("x").cast(WIDE)
    totals = counted.groupBy("k", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("x").cast(WIDE)).cast(WIDE).alias("s"), F.sum(square).cast(WIDE).alias("q")
    )
    # What a bucket has from the whole buckets up to ``back_seconds`` before it.
    ends = totals.withColumn("bucket", F.explode(F.sequence(F.col("bucket") + 1, F.col("bucket") + back // length)))
    base = ends.groupBy("k", "bucket").agg(
        F.sum("n").alias("n"), F.sum("s").cast(WIDE).alias("s"), F.sum("q").cast(WIDE).alias("q")
    )

    def step(frame: DataFrame, at: Column, bucket: Column, sign: int) -> DataFrame:
        return frame.select(
            "k", bucket.alias("bucket"), at.alias("t"), F.lit(sign).cast("bigint").alias("n"),
            (F.col("x") * sign).cast(WIDE).alias("s"), (square * sign).cast(WIDE).alias("q"),
        )

    own = rows.select(
        "k", "bucket", "t", "x", "row", F.col("x").isNotNull().cast("bigint").alias("n"),
        F.col("x").cast(WIDE).alias("s"), square.cast(WIDE).alias("q"),
    ).withColumn("own", F.lit(True))
    too_old = step(counted, F.col("t") + back, F.col("bucket") + back // length, -1)
    whole = base.select("k", "bucket", (F.col("bucket") * length - 1).alias("t"), "n", "s", "q")
    before = Window.partitionBy("k", "bucket").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    summed = own.unionByName(too_old, True).unionByName(whole, True).select(
        "row", "x", "own",
        F.when(known, F.coalesce(F.sum("n").over(before), F.lit(0))).alias("n"),
        F.sum("s").over(before).cast(WIDE).alias("s"),
        F.sum("q").over(before).cast(WIDE).alias("q"),
    ).where("own")
    wide = F.col("n").cast(WIDE)
    spread = (wide * F.col("q") - F.col("s") * F.col("s")).cast("double")
    mean = F.when(F.col("n") > 0, F.col("s").cast("double") / F.col("n"))
    sd = F.when(F.col("n") > 1, F.sqrt(spread / (F.col("n").cast("double") * (F.col("n") - 1))))
    return summed.select("row", "x", "n", mean.alias("mean"), sd.alias("sd")).select(
        "row.*",
        F.col("n").alias("baseline_n"),
        (F.col("mean") / scale).alias("baseline_mean"),
        (F.col("sd") / scale).alias("baseline_sd"),
        F.when(F.col("sd") > 0, (F.col("x") - F.col("mean")) / F.col("sd")).alias("baseline_z"),
    )
