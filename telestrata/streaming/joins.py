"""Two streams joined within a bound of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def acknowledged(readings: DataFrame, acks: DataFrame, delay: str, within_seconds: int) -> DataFrame:
    """Readings with each acknowledgement ``(ack_device, ack_time)`` of their device in time.

    An acknowledgement counts from the time of the reading to ``within_seconds`` after it. The
    bound limits the state of both streams: a reading leaves it, with nulls if nothing came, once
    the watermark (``delay`` behind the slower stream) has passed its bound. Batch frames give
    the same rows at once.

    Spark compares a row with everything that the other stream holds under its key. Bins of time,
    twice as long as the bound, are therefore part of the key: a reading lies in one bin; an
    acknowledgement in its own and, where a reading of the bin before can reach it, in that one too.
    """
    left = readings.withWatermark("timestamp", delay)
    right = acks.select("ack_device", "ack_time").withWatermark("ack_time", delay)
    bound = int(within_seconds) * 1_000_000
    length = max(2 * bound, 1)
    own, late = _bin(right, "ack_time", length)
    bins = F.when(late < bound, F.array(own, own - length)).otherwise(F.array(own))
    right = right.withColumn("ack_bin", F.explode(bins))
    in_time = F.expr(
        f"ack_time >= timestamp AND ack_time <= timestamp + INTERVAL {int(within_seconds)} SECONDS"
    )
    same = (F.col("device_id") == F.col("ack_device")) & (_bin(left, "timestamp", length)[0] == right["ack_bin"])
    return left.join(right, same & in_time, "leftOuter").drop(right["ack_bin"])


def _bin(df: DataFrame, column: str, length: int) -> tuple[Column, Column]:
    """Where the bin of a time begins, and how far the time lies in it, in microseconds."""
    at = F.col(column)
    if df.schema[column].dataType.typeName() == "timestamp_ntz":
        # As if in UTC: in other zones the hours of a day needn't follow each other evenly.
        at = F.concat(at.cast("string"), F.lit("Z")).cast("timestamp")
    at = F.unix_micros(at)
    late = F.pmod(at, F.lit(length))
    return at - late, late
