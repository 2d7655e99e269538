"""Sessions, joins in time and sketches against brute force, with hot devices."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from telestrata.operators import sessions, sketches, temporal

START = datetime(2024, 3, 1)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def readings(spark, rows):
    return spark.createDataFrame(
        rows, "device_id string, timestamp timestamp, _is_anomaly boolean, _quality_score double"
    ).repartition(3)


def random_readings(seed: int, n: int = 600) -> list:
    rng = random.Random(seed)
    rows = [
        (rng.choice(["hot"] * 6 + ["a", "b"]), at(rng.choice([rng.randrange(90_000), rng.randrange(90) * 1000])),
         rng.choice([True, False, None]), rng.choice([None, 0.25, 0.5001, 1.0]))
        for _ in range(n)
    ]
    return [*rows, ("a", None, True, 1.0), (None, at(5), True, 1.0)]


def plain_sessions(rows, gap: int) -> set:
    out = set()
    for device in {r[0] for r in rows if r[0]}:
        mine, open_ = sorted((r for r in rows if r[0] == device and r[1]), key=lambda r: r[1]), []
        for row in [*mine, None]:
            if open_ and (row is None or (row[1] - open_[-1][1]).total_seconds() > gap):
                scores = [round(r[3] * 10_000) for r in open_ if r[3] is not None]
                quality = round(sum(scores) / len(scores) / 10_000 + 1e-12, 4) if scores else None
                out.add((device, open_[0][1], open_[-1][1], len(open_), sum(r[2] is True for r in open_), quality))
                open_ = []
            if row is not None:
                open_.append(row)
    return out


@pytest.mark.parametrize("gap", [7, 100, 1000, 5000])
def test_sessions_of_a_batch(spark, gap):
    rows = random_readings(gap)
    assert set(map(tuple, sessions.device_sessions(readings(spark, rows), gap).collect())) == plain_sessions(rows, gap)


def test_sessions_of_a_stream_are_those_of_the_batch(spark, tmp_path):
    rows = random_readings(3, 200)
    gap = 1000
    source = readings(spark, rows)
    ordered = sorted((r for r in rows if r[1]), key=lambda r: r[1])
    for i in range(0, len(ordered), 60):
        readings(spark, ordered[i : i + 60]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    # A last row far ahead closes all sessions.
    readings(spark, [("end", at(10**6), None, None)]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = (
        sessions.device_sessions_stream(stream, gap, "200000 seconds")
        .writeStream.format("parquet").option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    )
    assert query.awaitTermination(120)
    got = set(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))
    assert got == plain_sessions(rows, gap)


def test_last_row_before(spark):
    rng = random.Random(1)
    left = [(rng.choice(["hot"] * 6 + ["a", "b", None]), at(rng.randrange(40_000)), i, "x") for i in range(400)]
    left += [("a", None, 1000, "x"), ("none", at(1), 1001, "x")]
    right = [(rng.choice(["hot"] * 3 + ["a", "b"]), at(rng.randrange(0, 40_000, 50)), rng.randrange(5)) for _ in range(200)]
    right += [(None, at(0), 9), ("a", None, 9)]
    a = spark.createDataFrame(left, "device string, seen timestamp, id int, score string").repartition(3)
    b = spark.createDataFrame(right, "device string, since timestamp, score int").repartition(3)
    joined = temporal.asof_join(a, b, "device", "seen", "since", ["score", "since"], slice_seconds=900)
    wanted = set()
    for device, seen, i, _ in left:
        found = [(s, v) for d, s, v in right if d == device and d and s and seen and s <= seen]
        since, score = max(found, default=(None, None))
        wanted.add((device, seen, i, score, since))
    assert joined.columns == ["device", "seen", "id", "score", "since"]
    assert set(map(tuple, joined.collect())) == wanted and joined.count() == len(left)


def test_a_hot_device_is_spread_over_its_slices(spark):
    """No window covers a device as a whole; the one over slices has a row per slice."""
    n = 20_000
    a = spark.range(n).selectExpr("'hot' as device", "timestamp_seconds(id) as seen", "id")
    b = spark.range(0, n, 10).selectExpr("'hot' as device", "timestamp_seconds(id) as since", "id as v")
    joined = temporal.asof_join(a, b, "device", "seen", "since", ["v"], slice_seconds=600)
    assert joined.where("v <> id div 10 * 10 or v is null").isEmpty()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_intervals_around_points(spark):
    rng = random.Random(2)
    points = [(rng.choice(["hot"] * 6 + ["a", None]), at(rng.randrange(50_000)), i) for i in range(300)]
    points += [("a", None, 900)]
    spans = []
    for i in range(80):
        low, length = rng.randrange(50_000), rng.choice([0, 1, 40, 300, 5000, 49_000])
        spans.append((rng.choice(["hot", "a", None]), at(low), at(low + length), i))
    spans += [("a", at(10), at(5), 100), ("a", None, at(5), 101)]
    a = spark.createDataFrame(points, "device string, seen timestamp, id int")
    b = spark.createDataFrame(spans, "device string, low timestamp, high timestamp, alert int")
    joined = temporal.interval_join(a, b, "device", "seen", "low", "high", ["alert", "low"], base_seconds=60)
    wanted = sorted(
        (d, seen, i, alert, low) for d, seen, i in points for e, low, high, alert in spans
        if d and d == e and seen and low and low <= seen < high
    )
    assert sorted(map(tuple, joined.collect())) == wanted and len(wanted) > 500
    assert temporal.interval_join(a, b.limit(0), "device", "seen", "low", "high", ["alert"]).count() == 0
    # No inequality join: the only nested loop is over the one row of levels.
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Cross") == 1 and "Join Inner, ((" in plan


def test_sketches_stay_within_their_bounds(spark):
    n = 60_000
    rows = spark.range(n).selectExpr(
        "timestamp_seconds(1709251200 + id * 5) as timestamp", "concat('d', pmod(xxhash64(id), 9000)) as device_id",
        "cast(pmod(xxhash64(id, 1), 100000) as double) as temperature", "if(id % 3 = 0, 'x', 'y') as location",
    )
    hours = sketches.hourly_sketches(rows, "temperature")
    days = sketches.estimates(sketches.rolled_up(hours)).collect()
    assert len(days) == 8 and sum(r.event_count for r in days) == n
    for r in days:
        mine = rows.where((F.date_trunc("day", "timestamp") == F.lit(r.day)) & (F.col("location") == r.location))
        exact = mine.agg(
            F.count_distinct("device_id").alias("devices"),
            *[F.avg((F.col("temperature") <= r[p]).cast("int")).alias(p) for p in ("p50", "p90", "p99")],
        ).first()
        assert abs(r.devices - exact.devices) <= exact.devices * sketches.DISTINCT_ERROR
        for p, q in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99)):
            assert abs(exact[p] - q) <= sketches.QUANTILE_ERROR + 0.002
    assert {f.dataType.simpleString() for f in hours.schema if f.name in ("devices", "readings")} == {"binary"}


def test_sketches_of_nothing(spark):
    rows = spark.createDataFrame([(at(0), None, None, "x"), (at(1), "d", float("nan"), "x")], "timestamp timestamp, device_id string, temperature double, location string")
    [row] = sketches.estimates(sketches.rolled_up(sketches.hourly_sketches(rows, "temperature"))).collect()
    assert (row.devices, row.p50, row.event_count) == (1, None, 2)
