import random
import statistics
from collections import defaultdict

import pytest

from telestrata.functions import exact_mean
from telestrata.operators import windows
from telestrata.plans.silver import apply_transformations
from tests.conftest import event
from tests.vectors import edge_feed, plain_gold, plain_silver, random_feed

FEED = random_feed()
PLAIN = plain_gold(plain_silver(FEED))


@pytest.fixture()
def silver(frame):
    return apply_transformations(frame(*FEED))


def by_window(df):
    return {(r.device_id, r.window_start.hour): r for r in df.collect()}


def near(value, places):
    return None if value is None else pytest.approx(value, abs=0.6 * 10**-places)


def test_device_summary(silver):
    table = windows.compute_device_summary(silver)
    rows = by_window(table)
    assert rows.keys() == PLAIN.keys() and len(table.columns) == 14
    for key, plain in PLAIN.items():
        row, temps = rows[key], plain["temps"]
        assert (row.event_count, row.anomaly_count) == (plain["n"], plain["anomalies"])
        assert row.avg_temperature == near(statistics.fmean(temps) if temps else None, 2)
        assert row.stddev_temperature == near(statistics.stdev(temps) if len(temps) > 1 else None, 2)
        assert (row.min_temperature, row.max_temperature) == (min(temps, default=None), max(temps, default=None))


def test_anomaly_summary(silver):
    table = windows.compute_anomaly_summary(silver)
    assert len(table.columns) == 9
    for key, row in by_window(table).items():
        plain = PLAIN[key]
        assert (row.temp_anomaly_count, row.humidity_anomaly_count, row.pressure_anomaly_count) == plain["kinds"]
        assert (row.total_events, row.total_anomaly_count) == (plain["n"], plain["anomalies"])
        assert row.anomaly_rate == near(plain["rate"], 4)


def same_health(table, plain_rows):
    rows = by_window(table)
    assert rows.keys() == plain_rows.keys()
    for key, plain in plain_rows.items():
        row = rows[key]
        assert row.event_count == plain["n"]
        assert row.avg_quality_score == near(plain["quality"], 4)
        assert row.anomaly_rate == near(plain["rate"], 4)
        assert row.avg_battery_level == near(plain["battery"], 2)
        assert row.health_score == near(plain["score"], 4)
        assert row.risk_tier == plain["tier"]


def test_device_health(silver):
    assert {p["tier"] for p in PLAIN.values()} == {"healthy", "warning", "critical"}
    same_health(windows.compute_device_health(silver), PLAIN)


def test_health_at_the_limits(frame):
    feed = edge_feed()
    same_health(windows.compute_device_health(apply_transformations(frame(*feed))), plain_gold(plain_silver(feed)))


def test_without_battery_the_score_is_unknown_and_the_tier_critical(frame):
    row = windows.compute_device_health(
        apply_transformations(frame(event(battery_level=None)))
    ).first()
    assert (row.health_score, row.risk_tier) == (None, "critical")


def test_weights_and_tiers_are_parameters(silver):
    config = {
        "gold": {
            "health_weights": {"quality": 1.0, "anomaly_rate": 0.0, "battery": 0.0},
            "risk_tiers": {"healthy": 0.95, "warning": 0.92},
        }
    }
    for key, row in by_window(windows.compute_device_health(silver, config)).items():
        if PLAIN[key]["score"] is None:
            assert (row.health_score, row.risk_tier) == (None, "critical")
            continue
        assert row.health_score == near(PLAIN[key]["quality"], 4)
        tier = "healthy" if row.health_score >= 0.95 else "warning" if row.health_score >= 0.92 else "critical"
        assert row.risk_tier == tier


def test_ml_features(silver):
    table = windows.compute_ml_features(silver)
    assert len(table.columns) == 35
    for key, row in by_window(table).items():
        plain = PLAIN[key]
        temps, batteries, z = plain["temps"], plain["batteries"], plain["z"]
        assert row.temp_range == (max(temps) - min(temps) if temps else None)
        assert row.temp_stddev == near(statistics.stdev(temps) if len(temps) > 1 else None, 4)
        assert (row.battery_min, row.battery_max) == (min(batteries, default=None), max(batteries, default=None))
        assert row.temp_zscore_abs_mean == near(statistics.fmean(z) if z else None, 4)
        assert row.temp_zscore_abs_max == max(z, default=None)
        assert row.quality_mean == near(plain["quality"], 4)


@pytest.mark.parametrize("window, starts", [("30 minutes", 4), ("1 hour", 2), ("2 hours", 1)])
def test_window_sizes(frame, window, starts):
    silver = apply_transformations(frame(*[event(m) for m in (0, 30, 60, 90)]))
    table = windows.compute_device_summary(silver, window)
    assert table.count() == starts
    first = table.orderBy("window_start").first()
    assert str(first.window_start) == "2024-11-05 10:00:00"
    assert sum(r.event_count for r in table.collect()) == 4


def test_tables_built_together_equal_tables_built_alone(silver):
    stats = windows.window_stats(silver)
    alone = {
        "device_summary": windows.compute_device_summary(silver),
        "anomaly_summary": windows.compute_anomaly_summary(silver),
        "device_health": windows.compute_device_health(silver),
        "ml_features": windows.compute_ml_features(silver),
    }
    for name, project in windows.GOLD_TABLES.items():
        together = project(stats, None)
        assert together.exceptAll(alone[name]).count() == 0
        assert together.count() == alone[name].count()


def test_a_table_built_alone_reads_only_what_it_needs(silver):
    plan = windows.compute_anomaly_summary(silver)._jdf.queryExecution().optimizedPlan().toString()
    assert "stddev" not in plan and "_quality_score" not in plan


def test_against_brute_force(spark):
    """Random readings with gaps; one device holds a third of the rows."""
    draw = random.Random(7)
    rows = []
    for i in range(3000):
        device = "hot" if i % 3 == 0 else f"d{draw.randrange(40)}"
        temp = None if draw.random() < 0.1 else round(draw.uniform(-80, 200), 2)
        rows.append((device, draw.randrange(6), temp, draw.random() < 0.2, draw.randrange(10_001) / 10_000))
    df = spark.createDataFrame(
        rows, "device_id string, h int, temperature double, _is_anomaly boolean, _quality_score double"
    ).selectExpr(
        "*",
        "timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, h, 7, 0) as timestamp",
        "_is_anomaly as _is_temp_anomaly",
        "false as _is_humidity_anomaly",
        "false as _is_pressure_anomaly",
        *[f"cast(null as double) as {c}" for c in ("humidity", "pressure", "battery_level")],
        *[f"cast(null as double) as _{c}_zscore" for c in ("temperature", "humidity", "pressure")],
    )
    groups = defaultdict(list)
    for device, h, *values in rows:
        groups[device, h].append(values)
    got = {(r.device_id, r.window_start.hour): r for r in windows.window_stats(df).collect()}
    assert got.keys() == groups.keys()
    for key, members in groups.items():
        row, temps = got[key], [t for t, _, _ in members if t is not None]
        assert row.n == len(members)
        assert row.any_n == sum(a for _, a, _ in members)
        assert row.quality_mean == pytest.approx(statistics.fmean(q for *_, q in members), abs=1e-12)
        assert row.temp_mean == (pytest.approx(statistics.fmean(temps)) if temps else None)
        assert row.temp_sd == (pytest.approx(statistics.stdev(temps)) if len(temps) > 1 else None)


def test_exact_mean_does_not_depend_on_order(spark):
    values = [0.8333, 0.9, 1.0, 0.8333] * 500 + [0.75] * 3
    means = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        means.add(df.agg(exact_mean("v", 4).alias("m")).first().m)
    assert len(means) == 1
    assert means.pop() == pytest.approx(statistics.fmean(values))


def test_exact_mean_of_odd_values(spark):
    def mean(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return df.agg(exact_mean("v", 2).alias("m")).first().m

    assert mean(None, None) is None
    assert mean(1.0, float("nan")) is None
    assert mean(1.0, float("inf")) is None
    assert mean(1e300, 1e300) is None
    assert mean(1.25, None, 1.75) == 1.5
