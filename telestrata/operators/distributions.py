"""Histograms, exact median, feature description and correlation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telestrata.functions import bucket_of
from telestrata.operators.windows import KEYS
from telestrata.settings import Settings

Config = Settings | Mapping | None
BLOCK = 8  # features correlated side by side in one row


def histogram(
    df: DataFrame, value: str, width: float, origin: float = 0.0, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per fixed-width bucket ``[low, low + width)`` and class.

    Missing and NaN values have no bucket. Buckets are merged inside each input
    partition first, so the shuffle carries buckets, not rows.
    """
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    counted = (
        known.withColumn("bucket", bucket_of(F.col(value), width, origin))
        .groupBy(*by, "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.withColumn("bucket_low", F.col("bucket") * float(width) + float(origin))


def sensor_histogram(
    silver: DataFrame, width: float = 10.0, config: Config = None
) -> DataFrame:
    """Readings in and out of range; rows with an undecided flag are left out."""
    rows = _stacked(
        silver,
        [(s.column, F.col(s.column), F.col(s.flag)) for s in Settings.of(config).sensors],
    ).where(F.col("flag").isNotNull())
    classed = rows.withColumn(
        "class", F.when(F.col("flag"), "out_of_range").otherwise("in_range")
    )
    return histogram(classed, "value", width, by=("sensor", "class"))


def zscore_histogram(
    silver: DataFrame, width: float = 0.5, config: Config = None
) -> DataFrame:
    """Z-scores of anomalous rows against all others (undecided ones included)."""
    anomalous = F.coalesce(F.col("_is_anomaly"), F.lit(False))
    rows = _stacked(
        silver,
        [(s.column, F.col(s.zscore), anomalous) for s in Settings.of(config).sensors],
    )
    return histogram(_named_classes(rows), "value", width, by=("sensor", "class"))


def quality_histogram(silver: DataFrame, width: float = 0.05) -> DataFrame:
    """Quality scores of clean and anomalous rows; undecided rows are left out."""
    rows = silver.select(
        F.col("_quality_score").alias("value"), F.col("_is_anomaly").alias("flag")
    ).where(F.col("flag").isNotNull())
    return histogram(_named_classes(rows), "value", width, by=("class",))


def health_histogram(device_health: DataFrame, width: float = 0.05) -> DataFrame:
    return histogram(device_health, "health_score", width, by=("risk_tier",))


def latency_histogram(latency: DataFrame, width: float = 5.0) -> DataFrame:
    return histogram(latency, "_latency_sec", width)


def histogram_2d(
    df: DataFrame, first: tuple[str, float], second: tuple[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Counts over the buckets of two columns, each given with its width; nulls are left out."""
    buckets = [
        (F.floor(F.col(c) / F.lit(width)) * F.lit(width)).alias(f"{c}_from") for c, width in (first, second)
    ]
    known = df.where(F.col(first[0]).isNotNull() & F.col(second[0]).isNotNull())
    return known.groupBy(*by, *buckets).agg(F.count(F.lit(1)).alias("n"))


def feature_histogram(
    features: DataFrame, width: float = 0.5, columns: Sequence[str] | None = None
) -> DataFrame:
    long = _features_long(features, columns or numeric_features(features))
    return histogram(long, "value", width, by=("feature",))


def _stacked(df: DataFrame, triples: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    return df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("sensor"), value.alias("value"), flag.alias("flag")
                    )
                    for name, value, flag in triples
                ]
            )
        )
    )


def _named_classes(rows: DataFrame) -> DataFrame:
    return rows.withColumn("class", F.when(F.col("flag"), "anomalous").otherwise("clean"))


def median_whole_number(df: DataFrame, value: str, bucket: int = 4096) -> DataFrame:
    """Exact median of a whole-number column, in one row ``median``.

    The values are counted per bucket, the buckets that hold the middle ranks are
    found from those counts, and only their values are ranked. No task sees more
    than the bucket totals or the distinct values of two buckets, whatever the
    number of rows.
    """
    # Both uses of ``counts`` keep the same filters, so Spark runs it once.
    counts = (
        df.select(F.col(value).cast("bigint").alias("v"))
        .withColumn("b", F.floor(F.col("v") / bucket))
        .where(F.col("v").isNotNull() & F.col("b").isNotNull())
        .groupBy("b", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    coarse = counts.groupBy("b").agg(F.sum("n").alias("n"))
    up_to = Window.orderBy("b")
    everything = Window.partitionBy()
    placed = coarse.select(
        "b",
        (F.sum("n").over(up_to) - F.col("n")).alias("before"),
        F.sum("n").over(up_to).alias("upto"),
        F.sum("n").over(everything).alias("total"),
    )
    # Ranks are counted from 1; an even count has two middle rows.
    middle = placed.withColumn(
        "rank",
        F.explode(
            F.array_distinct(
                F.array(
                    F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
                )
            )
        ),
    ).where((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("upto")))
    inside = counts.join(F.broadcast(middle.select("b", "rank", "before")), "b")
    running = Window.partitionBy("rank").orderBy("v")
    hit = inside.select(
        "v",
        "n",
        "rank",
        (F.col("before") + F.sum("n").over(running)).alias("upto"),
    ).where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
    return hit.agg(F.avg("v").alias("median"))


def numeric_features(features: DataFrame) -> list[str]:
    """All feature columns: everything but keys and stamps."""
    return [c for c in features.columns if c not in (*KEYS, "_aggregated_at")]


def _features_long(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    doubles = features.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot([], list(columns), "feature", "value")


def describe_features(
    features: DataFrame, columns: Sequence[str] | None = None, places: int | None = None
) -> DataFrame:
    """Count, mean, deviation and range of every feature, one row each."""
    long = _features_long(features, columns or numeric_features(features))

    def shown(c: Column) -> Column:
        return c if places is None else F.round(c, places)

    return long.groupBy("feature").agg(
        F.count("value").alias("count"),
        shown(F.avg("value")).alias("mean"),
        shown(F.stddev("value")).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


def feature_correlation(
    features: DataFrame, columns: Sequence[str] | None = None, places: int | None = None
) -> DataFrame:
    """Pearson correlation of every feature pair over the rows that have both.

    Each row meets itself once per feature and block of others, not once per pair: a block's
    moments stand side by side in one aggregate, few enough for compiled code. They are folded
    inside the task that reads the row, so the shuffle carries one row of moments per feature,
    block and partition, whatever the number of rows. A constant feature has no correlation and
    gives null.
    """
    names = list(columns or numeric_features(features))
    cells = [
        F.struct(F.lit(i).alias("i"), F.lit(start).alias("start"))
        for start in range(0, len(names), BLOCK)
        for i in range(min(start + BLOCK, len(names)))
    ]
    values = features.select(F.array(*[F.col(c).cast("double") for c in names]).alias("f"))
    met = values.select("f", F.inline(F.array(*cells))).select(
        "i", "start", F.get("f", "i").alias("x"),
        *[F.get("f", F.col("start") + k).alias(f"y{k}") for k in range(BLOCK)],
    )

    def moments(y: str) -> Column:
        x_there, y_there = F.when(F.col(y).isNotNull(), F.col("x")), F.when(F.col("x").isNotNull(), F.col(y))
        r = F.try_divide(F.covar_pop("x", y), F.sqrt(F.var_pop(x_there)) * F.sqrt(F.var_pop(y_there)))
        return r if places is None else F.round(r, places)

    blocks = met.groupBy("i", "start").agg(*[moments(f"y{k}").alias(f"r{k}") for k in range(BLOCK)])
    beside = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"r{k}").alias("correlation")) for k in range(BLOCK)])
    upper = (
        blocks.select("i", "start", F.inline(beside))
        .select("i", (F.col("start") + F.col("k")).alias("j"), "correlation")
        .where((F.col("i") <= F.col("j")) & (F.col("j") < len(names)))
    )
    # The matrix is symmetric: each pair below the diagonal mirrors one above it.
    both_ways = F.array(
        F.struct(F.col("i").alias("a"), F.col("j").alias("b")),
        F.struct(F.col("j").alias("a"), F.col("i").alias("b")),
    )
    mirrored = upper.select(F.inline(F.array_distinct(both_ways)), "correlation")
    labels = F.array(*[F.lit(c) for c in names])
    return mirrored.select(
        F.get(labels, F.col("a")).alias("feature"),
        F.get(labels, F.col("b")).alias("other"),
        "correlation",
    )
