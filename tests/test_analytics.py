"""Profiles, histograms, rankings and lineage against values worked out by hand
or by brute force."""

import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from telestrata.operators import distributions, enrich, health, lineage, profiles, windows
from telestrata.plans.silver import apply_transformations
from tests.conftest import event
from tests.vectors import edge_feed, plain_gold, plain_silver, random_feed

EDGES = edge_feed()
EDGE_ROWS = plain_silver(EDGES)
EDGE_ANOMALIES = sum(r["_is_anomaly"] is True for r in EDGE_ROWS)
EDGE_QUALITY = statistics.fmean(r["_quality_score"] for r in EDGE_ROWS)
TORN = sum(isinstance(x, str) for x in EDGES)
NO_KEY = sum(isinstance(x, str) or not {"device_id", "timestamp"} <= x.keys() for x in EDGES)
FEED = random_feed()
PLAIN = plain_gold(plain_silver(FEED))


@pytest.fixture()
def bronze(frame):
    return frame(*EDGES).withColumns(
        {"_ingested_at": F.current_timestamp(), "_source_file": F.lit("one.json")}
    )


@pytest.fixture()
def silver(bronze):
    return apply_transformations(bronze)


def health_rows(spark, rows):
    """device, window number, score, rate, battery, quality, tier"""
    df = spark.createDataFrame(
        rows,
        "device_id string, w int, health_score double, anomaly_rate double, "
        "avg_battery_level double, avg_quality_score double, risk_tier string",
    )
    start = F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, w, 0, 0)")
    return df.withColumn("window_start", start).drop("w")


def test_bronze_profile(bronze):
    row = profiles.bronze_profile(bronze).first()
    assert (row.total_rows, row.corrupt_records, row.source_files) == (len(EDGES), TORN, 1)
    assert row.distinct_devices == len({x.get("device_id") for x in EDGES if isinstance(x, dict)} - {None})


def test_silver_profile_and_breakdown(silver):
    row = profiles.silver_profile(silver).first()
    assert (row.total_rows, row.distinct_devices, row.anomaly_count) == (len(EDGE_ROWS), len(EDGE_ROWS), EDGE_ANOMALIES)
    assert row.min_quality_score == min(r["_quality_score"] for r in EDGE_ROWS)
    assert row.avg_quality_score == pytest.approx(EDGE_QUALITY)
    kinds = profiles.anomaly_breakdown(silver).first()
    assert tuple(kinds) == (2, 0, 2, EDGE_ANOMALIES) and EDGE_ANOMALIES == 4


def test_numeric_ranges(silver):
    row = profiles.numeric_ranges(silver).first()
    assert (row.temp_min, row.temp_max, row.hum_min, row.pres_max) == (-50.25, 150.25, 0, 1100.25)


def test_layer_funnel_counts_a_missing_table_as_empty(bronze, silver):
    layers = {"bronze": bronze, "silver": silver, "gold": None}
    rows = profiles.layer_funnel(layers).orderBy("position").collect()
    assert [(r.layer, r.row_count, r.rows_dropped) for r in rows] == [
        ("bronze", len(EDGES), 0),
        ("silver", len(EDGE_ROWS), len(EDGES) - len(EDGE_ROWS)),
        ("gold", 0, len(EDGE_ROWS)),
    ]
    kept = len(EDGE_ROWS) / len(EDGES)
    assert [r.share_of_first for r in rows] == [1.0, pytest.approx(kept, abs=1e-4), 0.0]
    assert [r.drop_rate for r in rows] == [0.0, pytest.approx(1 - kept, abs=1e-4), 1.0]


def test_dq_summary(bronze, silver):
    gold = {"device_health": windows.compute_device_health(silver)}
    got = {(r.layer, r.metric): r.value for r in profiles.dq_summary(bronze, silver, gold).collect()}
    assert got == {
        ("bronze", "total_records"): len(EDGES),
        ("bronze", "corrupt_records"): TORN,
        ("bronze", "null_key_records"): NO_KEY,
        ("silver", "clean_records"): len(EDGE_ROWS) - EDGE_ANOMALIES,
        ("silver", "anomalous_records"): EDGE_ANOMALIES,
        ("silver", "avg_quality_score"): pytest.approx(EDGE_QUALITY, abs=1e-4),
        ("gold", "aggregate_rows"): len(EDGE_ROWS),
    }


def test_device_rates_skip_undecided_rows(frame):
    silver = apply_transformations(
        frame(
            event(0),
            event(1, temperature=300),
            event(2, temperature=None),
            event(0, device_id="unknown", temperature=None),
        )
    )
    rows = {r.device_id: tuple(r)[1:] for r in profiles.device_anomaly_rate(silver).collect()}
    assert rows == {"unit-07": (2, 1, 0.5), "unknown": (0, 0, None)}
    minutes = profiles.anomaly_per_minute(silver).orderBy("minute").collect()
    assert [(m.total_events, m.anomaly_count, m.anomaly_rate) for m in minutes] == [
        (1, 0, 0.0),
        (1, 1, 1.0),
        (0, 0, None),
    ]


def test_only_devices_with_anomalies_fewest_first(frame):
    silver = apply_transformations(frame(*FEED, *[event(m, device_id="quiet") for m in range(3)]))
    totals = {}
    for (device, _), plain in PLAIN.items():
        totals[device] = totals.get(device, 0) + plain["anomalies"]
    rows = profiles.anomaly_by_device(windows.compute_anomaly_summary(silver)).collect()
    assert [(r.device_id, r.total_anomaly_count) for r in rows] == sorted(totals.items(), key=lambda x: (x[1], x[0]))


def test_device_abs_z(frame):
    silver = apply_transformations(frame(event(0, temperature=12), event(1, temperature=37)))
    assert profiles.device_abs_z(silver).first().avg_abs_temperature_z == 2.5


def test_z_and_rule_agreement(frame):
    silver = apply_transformations(
        frame(
            event(0, temperature=300),
            event(1, temperature=60),
            event(2, temperature=22),
            event(3, temperature=None),
        )
    )
    rows = {r.sensor: tuple(r)[1:] for r in profiles.z_rule_agreement(silver).collect()}
    assert rows["temperature"] == (1, 1, 0, 2)
    assert rows["pressure"] == (0, 0, 0, 4)
    wide = {"quality": {"expected": {"temperature": {"mean": 22, "stddev": 1000}}}}
    silver = enrich.add_zscores(silver, wide)
    rows = {r.sensor: tuple(r)[1:] for r in profiles.z_rule_agreement(silver).collect()}
    assert rows["temperature"] == (0, 0, 1, 3)


def test_battery_split(frame):
    silver = apply_transformations(
        frame(
            event(0, battery_level=29.9, temperature=300),
            event(1, battery_level=10, temperature=None),
            event(2, battery_level=30),
            event(3, battery_level=None),
        )
    )
    rows = {r.battery_group: tuple(r)[1:] for r in profiles.battery_split(silver).collect()}
    assert rows == {"low": (2, 1, 1.0), "healthy": (1, 0, 0.0)}


def test_histogram(spark):
    values = [-0.1, 0.0, 0.9, 1.0, 2.5, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {(r.bucket, r.bucket_low): r.n for r in distributions.histogram(df, "v", 1.0).collect()}
    assert got == {(-1, -1.0): 1, (0, 0.0): 2, (1, 1.0): 1, (2, 2.0): 1}
    shifted = distributions.histogram(df, "v", 2.0, origin=-1.0).collect()
    assert {r.bucket_low: r.n for r in shifted} == {-1.0: 3, 1.0: 2}


def test_class_histograms_treat_undecided_rows_by_their_own_rule(frame):
    silver = apply_transformations(frame(event(0), event(1, temperature=None), event(2, temperature=300)))

    def total(df, **where):
        for column, value in where.items():
            df = df.where(F.col(column) == value)
        return df.agg(F.sum("n")).first()[0]

    z = distributions.zscore_histogram(silver)
    assert total(z, sensor="pressure", **{"class": "clean"}) == 2
    assert total(z, sensor="pressure", **{"class": "anomalous"}) == 1
    quality = distributions.quality_histogram(silver)
    assert total(quality) == 2
    sensors = distributions.sensor_histogram(silver)
    assert total(sensors, sensor="temperature") == 2
    assert total(sensors, sensor="pressure") == 3


@pytest.mark.parametrize("size", [1, 2, 7, 1000, 1001])
def test_median_against_brute_force(spark, size):
    draw = random.Random(size)
    values = [draw.choice([3, 3, 3, draw.randrange(-9000, 50_000)]) for _ in range(size)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    assert distributions.median_whole_number(df, "v").first().median == statistics.median(values)
    assert distributions.median_whole_number(df, "v", bucket=10).first().median == statistics.median(values)


def test_median_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v bigint")
    assert distributions.median_whole_number(df, "v").first().median is None


def test_describe_and_correlation_against_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(400, 3)), columns=["a", "b", "c"])
    pdf["d"] = pdf["a"] * 2 - pdf["b"]
    pdf.loc[rng.random(400) < 0.3, "b"] = None
    pdf["flat"] = 5.0
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double, d double, flat double")
    expected = pdf.corr()
    rows = distributions.feature_correlation(df).collect()
    assert len(rows) == 25
    for r in rows:
        want = expected.loc[r.feature, r.other]
        assert r.correlation == (None if np.isnan(want) else pytest.approx(want, abs=1e-9))
    described = {r.feature: r for r in distributions.describe_features(df).collect()}
    for name in pdf:
        assert described[name]["count"] == pdf[name].count()
        assert described[name]["std"] == pytest.approx(pdf[name].std())
        assert described[name]["mean"] == pytest.approx(pdf[name].mean())


def test_rollup_and_most_common_tier(spark):
    rows = [
        ("a", 0, 0.4, 0.5, 20.0, 0.9, "critical"),
        ("a", 1, 0.9, 0.1, 80.0, 1.0, "healthy"),
        ("b", 0, 0.6, 0.2, 50.0, 0.8, "warning"),
        ("b", 1, 0.7, 0.2, 50.0, 0.8, "warning"),
        ("b", 2, None, 0.2, None, 0.8, "critical"),
    ]
    got = {r.device_id: r for r in health.device_rollup(health_rows(spark, rows)).collect()}
    assert got["a"].risk_tier == "critical"  # a tie goes to the first in the alphabet
    assert got["b"].risk_tier == "warning"
    assert (got["a"].avg_health, got["a"].min_health) == (0.65, 0.4)
    assert got["b"].avg_health == 0.65 and got["b"].avg_battery == 50.0


def test_rankings_break_ties_by_device_and_put_unknown_last(spark):
    rows = [
        ("d", 0, None, 0.0, 10.0, 1.0, "critical"),
        ("c", 0, 0.5, 0.0, 10.0, 1.0, "warning"),
        ("b", 0, 0.5, 0.0, 10.0, 1.0, "warning"),
        ("a", 0, 0.9, 0.0, 10.0, 1.0, "healthy"),
    ]
    table = health_rows(spark, rows)
    assert [r.device_id for r in health.lowest_health(table, 4).collect()] == ["b", "c", "a", "d"]
    ranked = health.ranked_devices(health.device_rollup(table))
    assert [r.device_id for r in ranked.collect()] == ["b", "c", "a", "d"]
    trend = health.health_trend(table, 2).collect()
    assert {r.device_id for r in trend} == {"b", "c"}


def test_components_add_up_to_the_score(frame):
    table = windows.compute_device_health(apply_transformations(frame(*FEED)))
    scored = [r for r in health.lowest_health(table, len(PLAIN)).collect() if r.health_score is not None]
    assert len(scored) == sum(p["score"] is not None for p in PLAIN.values())
    for r in scored:
        parts = r.quality_component + r.anomaly_component + r.battery_component
        assert parts == pytest.approx(r.health_score, abs=1e-4)
    means = {}
    for (device, _), plain in PLAIN.items():
        means.setdefault(device, []).append(plain["score"])
    worst = health.health_decomposition(health.device_rollup(table), 1).first()
    assert worst.device_id == min(means, key=lambda d: statistics.fmean(x for x in means[d] if x is not None))


def test_tiers_and_stats(frame):
    table = windows.compute_device_health(apply_transformations(frame(*FEED)))
    tiers = [p["tier"] for p in PLAIN.values()]
    shares = {r.risk_tier: (r.n, r.share) for r in health.risk_tiers(table).collect()}
    assert shares == {t: (tiers.count(t), pytest.approx(tiers.count(t) / len(tiers))) for t in set(tiers)}
    scores = [p["score"] for p in PLAIN.values() if p["score"] is not None]
    stats = health.health_stats(table).first()
    assert (stats.min_health, stats.max_health) == pytest.approx((min(scores), max(scores)), abs=1e-4)


def test_kpis(frame):
    silver = apply_transformations(
        frame(*FEED).withColumn("_ingested_at", F.current_timestamp())
    )
    figures = health.kpis(
        windows.compute_anomaly_summary(silver),
        windows.compute_device_health(silver),
        enrich.processing_latency(silver),
    )
    got = {r.kpi: r.value for r in figures.collect()}
    assert got["total_anomalies"] == sum(p["anomalies"] for p in PLAIN.values())
    assert got["critical_windows"] == sum(p["tier"] == "critical" for p in PLAIN.values())
    assert got["median_latency_sec"] == 0


def test_features_join_health_of_the_same_window_without_another_shuffle(frame):
    silver = apply_transformations(frame(event(0), event(60), event(0, device_id="x")))
    joined = health.join_features_health(
        windows.compute_ml_features(silver), windows.compute_device_health(silver)
    )
    assert joined.count() == 3
    assert joined.where("health_score is null").count() == 0
    fanned = health.join_features_health(
        windows.compute_ml_features(silver), windows.compute_device_health(silver), on=["device_id"]
    )
    assert fanned.count() == 5  # two windows of one device pair up four times


def shuffles(df):
    """Hash shuffles and reused ones in the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    reused = plan.count("ReusedExchange")
    return plan.count("Exchange hashpartitioning") - reused, reused


def test_joins_add_no_shuffle(spark, frame):
    """Without broadcasting, the two aggregates are all that is shuffled."""
    silver = apply_transformations(frame(event(0), event(60), event(0, device_id="x")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        features = windows.compute_ml_features(silver)
        joined = health.join_features_health(features, windows.compute_device_health(silver))
        assert sum(shuffles(joined)) == 2 * sum(shuffles(features))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_table_used_twice_is_computed_once(spark, frame, tmp_path):
    path = str(tmp_path / "silver")
    apply_transformations(frame(*FEED)).write.parquet(path)
    table = windows.compute_device_health(spark.read.parquet(path))
    assert shuffles(health.health_trend(table, 2))[1] == 1
    numbers = spark.read.parquet(path).select(F.second("timestamp").alias("v"))
    assert shuffles(distributions.median_whole_number(numbers, "v"))[1] == 1


def test_unmatched_features_are_kept(spark, frame):
    silver = apply_transformations(frame(event(0)))
    nothing = windows.compute_device_health(silver).where("false")
    row = health.join_features_health(windows.compute_ml_features(silver), nothing).first()
    assert row.health_score is None


def test_top_k(frame):
    silver = apply_transformations(frame(*FEED))
    top = health.top_windows(windows.compute_device_summary(silver), 3).collect()
    largest = sorted(PLAIN, key=lambda key: (-PLAIN[key]["n"], key))[:3]
    assert [(r.device_id, r.window_start.hour) for r in top] == largest
    decided, distance = {}, {}
    for row in plain_silver(FEED):
        if row["_is_anomaly"] is not None:
            decided.setdefault(row["device_id"], []).append(row["_is_anomaly"])
        if row["_temperature_zscore"] is not None:
            distance.setdefault(row["device_id"], []).append(abs(row["_temperature_zscore"]))
    rates = health.top_anomaly_rate(profiles.device_anomaly_rate(silver), 2).collect()
    assert [r.device_id for r in rates] == sorted(decided, key=lambda d: (-statistics.fmean(decided[d]), d))[:2]
    unusual = health.top_abs_z(profiles.device_abs_z(silver), 1).collect()
    assert [r.device_id for r in unusual] == sorted(distance, key=lambda d: (-statistics.fmean(distance[d]), d))[:1]


def test_schema_diff(bronze, silver):
    rows = {r.column_name: r for r in lineage.schema_diff(bronze, silver).collect()}
    assert {c for c, r in rows.items() if r.change == "dropped"} == {"_corrupt_record", "_source_file"}
    assert sum(r.change == "added" for r in rows.values()) == 10
    assert (rows["device_id"].filled_before, rows["device_id"].filled_after) == (
        sum("device_id" in x for x in EDGES if isinstance(x, dict)), len(EDGE_ROWS)
    )
    assert rows["_corrupt_record"].filled_before == TORN
