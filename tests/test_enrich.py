import math

import pytest
from pyspark.sql import functions as F

from telestrata.operators import enrich
from telestrata.plans.silver import apply_transformations
from telestrata.settings import Settings
from tests.conftest import event
from tests.vectors import edge_feed, plain_silver, random_feed

FLAGS = ("_is_temp_anomaly", "_is_humidity_anomaly", "_is_pressure_anomaly", "_is_anomaly")
ZSCORES = ("_temperature_zscore", "_humidity_zscore", "_pressure_zscore")


def flags(row):
    return tuple(row[f] for f in FLAGS)


@pytest.mark.parametrize("given, kept", [(-15.0, 0.0), (0.0, 0.0), (55.5, 55.5), (100.0, 100.0), (140.0, 100.0)])
def test_humidity_is_clamped(frame, given, kept):
    assert enrich.normalize_units(frame(event(humidity=given))).first().humidity == kept


def test_missing_humidity_becomes_full_unless_asked_to_stay(frame):
    df = frame(event(humidity=None))
    assert enrich.normalize_units(df).first().humidity == 100.0
    assert enrich.normalize_units(df, null_safe=True).first().humidity is None


@pytest.mark.parametrize(
    "column, value, anomalous",
    [
        ("temperature", 150.0, False),
        ("temperature", 150.01, True),
        ("temperature", -50.0, False),
        ("temperature", -50.01, True),
        ("humidity", 100.0, False),
        ("humidity", 100.01, True),
        ("humidity", 0.0, False),
        ("humidity", -0.01, True),
        ("pressure", 1100.0, False),
        ("pressure", 1100.01, True),
        ("pressure", 900.0, False),
        ("pressure", 899.99, True),
    ],
)
def test_limits_are_inclusive(frame, column, value, anomalous):
    row = enrich.tag_anomalies(frame(event(**{column: value}))).first()
    assert row._is_anomaly is anomalous
    assert row._anomaly_details == (f"{column}_out_of_range" if anomalous else None)


def test_reasons_are_joined_in_sensor_order(frame):
    row = enrich.tag_anomalies(frame(event(temperature=-80, humidity=101, pressure=1200))).first()
    assert row._anomaly_details == (
        "temperature_out_of_range, humidity_out_of_range, pressure_out_of_range"
    )


def test_flags_are_three_valued(frame):
    unknown = enrich.tag_anomalies(frame(event(temperature=None))).first()
    assert flags(unknown) == (None, False, False, None)
    assert unknown._anomaly_details is None
    certain = enrich.tag_anomalies(frame(event(temperature=None, pressure=1200))).first()
    assert flags(certain) == (None, False, True, True)


def test_nan_is_above_every_limit(frame):
    df = frame('{"device_id":"d","timestamp":"2024-11-05T10:00:00Z","temperature":NaN}')
    tagged = enrich.add_zscores(enrich.tag_anomalies(df)).first()
    assert tagged._is_temp_anomaly is True
    assert math.isnan(tagged._temperature_zscore)


def test_zscores_follow_the_expected_population(frame):
    config = {"quality": {"expected": {"temperature": {"mean": 20, "stddev": 3}}}}
    row = enrich.add_zscores(frame(event(temperature=24, humidity=55, pressure=None)), config).first()
    assert row._temperature_zscore == 1.33
    assert row._humidity_zscore == 0.0
    assert row._pressure_zscore is None


def test_a_population_without_spread_gives_no_zscore(frame):
    config = {"quality": {"expected": {"temperature": {"mean": 20, "stddev": 0}}}}
    assert enrich.add_zscores(frame(event()), config).first()._temperature_zscore is None


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, 1.0),
        ({"temperature": 300}, 0.9),
        ({"location": None, "firmware_version": None}, 0.6667),
        ({"location": None, "firmware_version": None, "temperature": 300}, 0.6),
        ({"temperature": None}, 0.8333),
    ],
)
def test_quality_score(frame, changes, expected):
    tagged = enrich.tag_anomalies(frame(event(**changes)))
    assert enrich.add_quality_score(tagged).first()._quality_score == expected


def test_scoring_parameters(frame):
    config = {"quality": {"scoring": {"optional_fields": ["location"], "anomaly_penalty": 0.5}}}
    tagged = enrich.tag_anomalies(frame(event(temperature=300)))
    assert enrich.add_quality_score(tagged, config).first()._quality_score == 0.5
    with pytest.raises(ValueError, match="optional_fields"):
        Settings(optional_fields=())


def test_slices_leave_out_undecided_rows(frame):
    df = enrich.tag_anomalies(frame(event(), event(temperature=300), event(temperature=None)))
    assert enrich.only_anomalies(df).count() == 1
    assert enrich.only_clean(df).count() == 1


@pytest.mark.parametrize("feed", [edge_feed(), random_feed()], ids=["limits", "random"])
def test_silver_equals_plain_python(frame, feed):
    expected = plain_silver(feed)
    rows = {(r.device_id, r.timestamp.strftime("%H:%M")): r for r in apply_transformations(frame(*feed)).collect()}
    assert len(rows) == len(expected)
    for plain in expected:
        row = rows[plain["device_id"], plain["timestamp"][11:16]]
        for column in ("humidity", "temperature", "location", *FLAGS, *ZSCORES, "_quality_score"):
            assert row[column] == plain[column], (column, plain)


def test_silver_columns(frame):
    bronze = frame(event()).withColumns(
        {"_ingested_at": F.current_timestamp(), "_source_file": F.lit("f")}
    )
    silver = apply_transformations(bronze)
    assert len(silver.columns) == 19
    assert silver.columns[8] == "_ingested_at" and silver.columns[-1] == "_processed_at"
    assert "_source_file" not in silver.columns


def test_only_keys_given(frame):
    bare = '{"device_id":"d","timestamp":"2024-11-05T10:00:00Z"}'
    row = apply_transformations(frame(bare)).first()
    assert (row.humidity, flags(row)) == (100.0, (None, False, None, None))
    assert tuple(row[c] for c in ZSCORES) == (None, 4.5, None)
    assert row._quality_score == 0.1667


def test_latency_is_in_whole_seconds(spark):
    df = spark.sql(
        "select 'd' device_id, timestamp'2025-01-01 00:00:00.900' _ingested_at, "
        "timestamp'2025-01-01 00:00:01.100' _processed_at, 1.0D _quality_score, true _is_anomaly"
    )
    assert enrich.processing_latency(df).first()._latency_sec == 1
