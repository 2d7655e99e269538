"""Sketches that merge: distinct devices and quantiles, rolled up without rereading Silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG2_CELLS = 12  # of a distinct count; its relative deviation is about 1.04 / sqrt(2 ** 12)
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LOG2_CELLS / 2)
QUANTILE_K = 400  # of a quantile sketch; its rank error is about 2.3 / k ** 0.9
QUANTILE_ERROR = 3 * 2.3 / QUANTILE_K**0.9


def hourly_sketches(silver: DataFrame, value: str, by: Sequence[str] = ("location",)) -> DataFrame:
    """``(hour, *by, devices, readings, event_count)``: sketches of bounded size for each hour.

    Sketches are built in the partial aggregate, so one sketch per task and group is shuffled.
    """
    hour = F.window("timestamp", "1 hour")["start"].alias("hour")
    known = F.when(~F.isnan(value), F.col(value))
    return silver.groupBy(hour, *by).agg(
        F.hll_sketch_agg("device_id", LOG2_CELLS).alias("devices"),
        F.kll_sketch_agg_double(known, QUANTILE_K).alias("readings"),
        F.count(F.lit(1)).alias("event_count"),
    )


def rolled_up(sketches: DataFrame, unit: str = "day", by: Sequence[str] = ("location",)) -> DataFrame:
    """The sketches of longer stretches, merged from those of hours alone."""
    return sketches.groupBy(F.date_trunc(unit, "hour").alias(unit), *by).agg(
        F.hll_union_agg("devices").alias("devices"),
        F.kll_merge_agg_double("readings").alias("readings"),
        F.sum("event_count").alias("event_count"),
    )


def estimates(sketches: DataFrame, quantiles: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Sketches as numbers: ``devices`` and ``p50``-like columns, null where nothing was read."""
    named = {f"p{round(q * 100)}": q for q in quantiles}
    some = F.kll_sketch_get_n_double("readings") > 0
    return sketches.select(
        *[c for c in sketches.columns if c not in ("devices", "readings")],
        F.hll_sketch_estimate("devices").alias("devices"),
        *[F.when(some, F.kll_sketch_get_quantile_double("readings", F.lit(q))).alias(n) for n, q in named.items()],
    )
