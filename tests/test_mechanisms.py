"""Baselines, subtotals, changes, rescued fields and joined streams against plain Python."""

from __future__ import annotations

import json
import random
import statistics
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from telestrata.operators import changes, distributions, rolling, rollups, windows
from telestrata.plans.silver import apply_transformations
from telestrata.sources import snapshots
from telestrata.sources.landing import parse_lines
from telestrata.streaming.joins import acknowledged
from telestrata.streaming.sinks import drained
from tests.conftest import event
from tests.vectors import plain_gold, plain_silver, random_feed

START = datetime(2024, 3, 1)


@pytest.mark.parametrize("back, bucket", [(3600, 600), (7200, 7200), (300, 100)])
def test_baselines_with_a_hot_device(spark, back, bucket):
    """Ties, gaps, readings exactly ``back`` apart, nulls, NaN; one device holds most rows."""
    draw = random.Random(back)
    rows = []
    for i in range(500):
        seconds = draw.choice([draw.randrange(20_000), draw.randrange(20) * back])
        value = draw.choice([None, float("nan"), 7.25, 7.25, round(draw.uniform(-90, 90), 2)])
        rows.append((i, draw.choice(["hot"] * 4 + ["a", None]), START + timedelta(seconds=seconds), value, i % 3))
    rows.append((500, "a", None, 1.0, 0))
    df = spark.createDataFrame(rows, "i int, device_id string, timestamp timestamp, v double, n int").repartition(3)
    found = {r.i: r for r in rolling.rolling_baseline(df, "v", back_seconds=back, bucket_seconds=bucket).collect()}
    assert len(found) == 501
    for i, device, t, value, n in rows:
        row = found[i]
        assert row.n == n
        if device is None or t is None:
            assert (row.baseline_n, row.baseline_mean, row.baseline_z) == (None, None, None)
            continue
        past = [v for _, d, u, v, _ in rows if d == device and u and v is not None and v == v
                and t - timedelta(seconds=back) <= u < t]
        assert row.baseline_n == len(past)
        assert row.baseline_mean == (pytest.approx(statistics.fmean(past), abs=1e-9) if past else None)
        sd = statistics.stdev(past) if len(past) > 1 else None
        assert row.baseline_sd == (pytest.approx(sd, abs=1e-9) if sd is not None else None)
        fine = sd and sd > 1e-9 and value is not None and value == value
        assert row.baseline_z == (pytest.approx((value - statistics.fmean(past)) / sd, abs=1e-6) if fine else None)


def test_baseline_lengths_must_fit(spark):
    with pytest.raises(ValueError, match="multiple"):
        rolling.rolling_baseline(spark.range(1), "id", back_seconds=100, bucket_seconds=30)


def test_subtotals(frame):
    feed = random_feed()
    silver = apply_transformations(frame(*feed, *[event(m, device_id="busy", location=None) for m in (241, 242)]))
    rows = rollups.with_tiers(silver, windows.compute_device_health(silver), ("location",))
    got = {(r.location, r.risk_tier, r.level): r for r in rollups.subtotals(rows, ("location", "risk_tier")).collect()}
    plain = plain_silver([*feed, *[event(m, device_id="busy", location=None) for m in (241, 242)]])
    tiers = {k: v["tier"] for k, v in plain_gold(plain).items()}
    events, anomalies = Counter(), Counter()
    for row in plain:
        place, tier = row["location"], tiers[row["device_id"], int(row["timestamp"][11:13])]
        for key in ((place, tier, 0), (place, None, 1), (None, tier, 2), (None, None, 3)):
            events[key] += 1
            anomalies[key] += row["_is_anomaly"] is True
    assert {k: (r.events, r.anomalies) for k, r in got.items()} == {k: (n, anomalies[k]) for k, n in events.items()}
    chosen = rollups.subtotals(rows, ("location", "risk_tier"), [("risk_tier",), ()]).collect()
    assert {(r.risk_tier, r.level) for r in chosen} == {(k[1], k[2]) for k in events if k[2] >= 2}


def test_row_changes_count_copies(spark):
    draw = random.Random(5)
    sides = [[(draw.choice(["x", None, "y"]), draw.randrange(3)) for _ in range(n)] for n in (60, 80)]
    old, new = (spark.createDataFrame(s, "a string, b int").repartition(3) for s in sides)
    n = [Counter(s) for s in sides]
    expected = {("added", c, *k) for k, c in (n[1] - n[0]).items()} | {("removed", c, *k) for k, c in (n[0] - n[1]).items()}
    assert set(map(tuple, changes.row_changes(old, new).collect())) == expected
    assert changes.row_changes(old, old).count() == 0
    wider = changes.row_changes(old.limit(0), new.withColumn("c", F.lit(1)))
    assert wider.columns == ["change", "copies", "a", "b", "c"]


def test_keyed_changes(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (None, "n", 0.0)], "k int, a string, b double")
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (4, "d", 4.0), (None, "m", 1.0)], "k int, a string, b double")
    rows = {r.k: (r.change, r.changed_columns) for r in changes.keyed_changes(old, new, ["k"]).collect()}
    assert rows == {2: ("changed", ["b"]), 3: ("removed", None), 4: ("added", None), None: ("changed", ["a", "b"])}


def test_versions_are_compared_without_what_they_share(spark, tmp_path):
    path = str(tmp_path / "t")
    for low in (0, 10, 20):
        snapshots.commit(spark.range(low, low + 10), path, "append")
    old, new = snapshots.unshared(spark, path, 0, 2)
    assert (old.count(), new.count()) == (0, 20)
    assert changes.row_changes(old, new).count() == 20


def test_unknown_fields_keep_types_and_nesting(spark):
    full = event(0, rack=2.5, radio={"band": "n", "cells": [1, 7]})
    texts = [json.dumps(full), json.dumps(event(1)), "[1, 2]", "torn {", "", json.dumps(event(2, rack="two"))]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "value string")
    parsed = parse_lines(df, rescued="more")
    assert parsed.drop("more").exceptAll(parse_lines(df)).count() == 0
    read = parsed.select(
        F.minute("timestamp").alias("m"), F.variant_get("more", "$.radio.cells[1]", "int").alias("cell"),
        F.try_variant_get("more", "$.rack", "double").alias("rack"), F.schema_of_variant("more").alias("kind"),
    ).where("m is not null")
    rows = {r.m: (r.cell, r.rack) for r in read.collect()}
    assert rows == {0: (7, 2.5), 1: (None, None), 2: (None, None)}
    assert parsed.where("more is not null").count() == 2


@pytest.mark.parametrize("files", [1, 3])
def test_joined_streams_equal_the_batch(spark, tmp_path, files):
    draw = random.Random(files)
    rows = [(draw.choice(["hot"] * 3 + ["a"]), START + timedelta(minutes=draw.randrange(600))) for _ in range(60)]
    acks = [(draw.choice(["hot", "a", "b"]), START + timedelta(minutes=draw.randrange(600))) for _ in range(25)]
    last = START + timedelta(days=9)
    left = spark.createDataFrame(rows, "device_id string, timestamp timestamp")
    right = spark.createDataFrame(acks, "ack_device string, ack_time timestamp")
    waves = [(left, right), (spark.createDataFrame([("end", last)], left.schema), spark.createDataFrame([("no", last)], right.schema))]
    for one, two in waves:
        one.repartition(files).write.mode("append").parquet(f"{tmp_path}/l")
        two.repartition(files).write.mode("append").parquet(f"{tmp_path}/r")
        limited = spark.readStream.option("maxFilesPerTrigger", 1)
        streams = (limited.schema(f.schema).parquet(f"{tmp_path}/{n}") for f, n in ((left, "l"), (right, "r")))
        drained(
            acknowledged(*streams, "10 hours", 1800).writeStream.format("parquet").option("path", f"{tmp_path}/out")
            .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        )
    expected = Counter()
    for device, t in rows:
        hits = [a for d, a in acks if d == device and t <= a <= t + timedelta(minutes=30)]
        expected.update((device, t, a) for a in hits or [None])
    got = spark.read.parquet(f"{tmp_path}/out").where("device_id <> 'end'")
    assert Counter((r.device_id, r.timestamp, r.ack_time) for r in got.collect()) == expected


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("within", [0, 1800])
def test_acknowledgements_meet_in_bins_of_time(spark, kind, within):
    """Bounds met exactly or missed by a microsecond, times before 1970, nulls; time is part of the join's key."""
    draw = random.Random(within)
    bases = [datetime(1969, 12, 31, 23, 30), datetime(1970, 1, 1), START, START + timedelta(seconds=2 * within)]
    edges = [timedelta(seconds=s, microseconds=u) for s in (0, within, -within) for u in (-1, 0, 1)]
    rows = [(i, draw.choice(["a", "b", None]), draw.choice(bases) + draw.choice(edges)) for i in range(60)]
    rows.append((60, "a", None))
    acks = [(draw.choice(["a", "b", None]), draw.choice(bases) + draw.choice(edges)) for _ in range(40)] + [("a", None)]
    left = spark.createDataFrame(rows, "i int, device_id string, timestamp timestamp_ntz")
    right = spark.createDataFrame(acks, "ack_device string, ack_time timestamp_ntz")
    left = left.withColumn("timestamp", left["timestamp"].cast(kind))
    right = right.withColumn("ack_time", right["ack_time"].cast(kind))
    found = acknowledged(left, right, "1 hour", within)
    assert found.columns == ["i", "device_id", "timestamp", "ack_device", "ack_time"]
    expected = Counter()
    for i, device, t in rows:
        hits = [a for d, a in acks if device and d == device and t and a and t <= a <= t + timedelta(seconds=within)]
        expected.update((i, a) for a in hits or [None])
    shown = found.select("i", found["ack_time"].cast("timestamp_ntz").alias("at"))
    assert Counter((r.i, r["at"]) for r in shown.collect()) == expected
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    join = next(x for x in plan.splitlines() if "Join" in x)
    assert "pmod" in join and "ack_bin" in join


def test_correlation_of_many_features(spark):
    """More features than a block, with gaps in pairs and a constant."""
    draw = random.Random(2)
    names = [f"f{i}" for i in range(11)]
    rows = [[None if draw.random() < 0.2 else draw.gauss(0, 1) + 0.3 * i for i in range(10)] + [4.0] for _ in range(80)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    got = {(r.feature, r.other): r.correlation for r in distributions.feature_correlation(df, names).collect()}
    assert len(got) == 121
    for (a, b), r in got.items():
        pairs = [(x[names.index(a)], x[names.index(b)]) for x in rows]
        pairs = [p for p in pairs if None not in p]
        if "f10" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(statistics.correlation(*zip(*pairs)), abs=1e-9)
