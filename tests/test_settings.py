import pytest

from telestrata.settings import Settings


def test_defaults():
    s = Settings.of(None)
    assert [x.column for x in s.sensors] == ["temperature", "humidity", "pressure"]
    assert (s.watermark, s.window_duration, s.trigger_interval) == ("86400 seconds", "1 hour", "10 seconds")
    assert s.gold_retention_hours == 0


def test_a_nested_mapping_overrides_what_it_names():
    s = Settings.of(
        {
            "quality": {
                "max_temperature": 90,
                "dedup_window_hours": 6,
                "expected": {"pressure": {"stddev": 2}},
                "scoring": {"anomaly_penalty": 0.5, "optional_fields": ["location"]},
            },
            "gold": {
                "window_duration": "2 hours",
                "health_weights": {"battery": 0.1},
                "risk_tiers": {"warning": 0.4},
                "maintenance": {"optimize_enabled": True, "silver_retention_hours": 1},
            },
            "streaming": {"max_files_per_trigger": 7, "trigger_interval": "1 minute"},
            "unknown": {"ignored": True},
        }
    )
    temperature, _, pressure = s.sensors
    assert (temperature.low, temperature.high) == (-50.0, 90.0)
    assert (pressure.mean, pressure.stddev) == (1013.25, 2.0)
    assert (s.watermark, s.optional_fields, s.anomaly_penalty) == ("21600 seconds", ("location",), 0.5)
    assert (s.window_duration, s.battery_weight, s.quality_weight) == ("2 hours", 0.1, 0.4)
    assert (s.warning_from, s.healthy_from) == (0.4, 0.8)
    assert s.optimize_enabled and not s.vacuum_enabled and s.silver_retention_hours == 1
    assert (s.max_files_per_trigger, s.trigger_interval) == (7, "1 minute")


def test_settings_pass_through_unchanged():
    s = Settings(window_duration="5 minutes")
    assert Settings.of(s) is s


def test_sensor_names():
    names = [(s.flag, s.zscore, s.reason) for s in Settings().sensors]
    assert names[1] == ("_is_humidity_anomaly", "_humidity_zscore", "humidity_out_of_range")


@pytest.mark.parametrize("field", ["anomaly_penalty", "healthy_from"])
def test_settings_do_not_change_in_place(field):
    with pytest.raises(AttributeError):
        setattr(Settings(), field, 1.0)
