"""Parameters of the layers.

Every operator takes a ``Settings`` (or a nested mapping with the sections
``quality``, ``gold`` and ``streaming``) so thresholds, weights and windows are
data, and the sensor list drives the columns that are generated.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Sensor:
    """One sensor column with its accepted range and its expected population."""

    column: str
    short: str  # prefix of the feature columns
    label: str  # infix of the flag and the summary count
    low: float
    high: float
    mean: float
    stddev: float

    @property
    def flag(self) -> str:
        return f"_is_{self.label}_anomaly"

    @property
    def zscore(self) -> str:
        return f"_{self.column}_zscore"

    @property
    def reason(self) -> str:
        return f"{self.column}_out_of_range"


# Default sensor ranges, populations, weights and tiers.
DEFAULT_SENSORS = (
    Sensor("temperature", "temp", "temp", -50.0, 150.0, 22.0, 5.0),
    Sensor("humidity", "hum", "humidity", 0.0, 100.0, 55.0, 10.0),
    Sensor("pressure", "pres", "pressure", 900.0, 1100.0, 1013.25, 10.0),
)
DEFAULT_OPTIONAL_FIELDS = (
    "temperature",
    "humidity",
    "pressure",
    "battery_level",
    "location",
    "firmware_version",
)
KEY_COLUMNS = ("device_id", "timestamp")
TIERS = ("healthy", "warning", "critical")


@dataclass(frozen=True)
class Settings:
    sensors: tuple[Sensor, ...] = DEFAULT_SENSORS
    optional_fields: tuple[str, ...] = DEFAULT_OPTIONAL_FIELDS
    anomaly_penalty: float = 0.9
    dedup_window_hours: float = 24
    window_duration: str = "1 hour"
    quality_weight: float = 0.4
    anomaly_weight: float = 0.3
    battery_weight: float = 0.3
    healthy_from: float = 0.8
    warning_from: float = 0.5
    trigger_interval: str = "10 seconds"
    max_files_per_trigger: int = 100
    output_mode: str = "append"
    optimize_enabled: bool = False
    vacuum_enabled: bool = False
    bronze_retention_hours: float = 168
    silver_retention_hours: float = 720
    gold_retention_hours: float = 0

    def __post_init__(self):
        if not self.optional_fields:
            raise ValueError("optional_fields must name at least one column")

    @property
    def watermark(self) -> str:
        return f"{round(self.dedup_window_hours * 3600)} seconds"

    @classmethod
    def of(cls, config: "Settings | Mapping | None") -> "Settings":
        """Accept a ``Settings``, a nested mapping, or nothing (defaults)."""
        if isinstance(config, Settings):
            return config
        return cls.from_mapping(config or {})

    @classmethod
    def from_mapping(cls, config: Mapping) -> "Settings":
        base = cls()
        quality = config.get("quality", {})
        expected = quality.get("expected", {})
        gold = config.get("gold", {})
        scoring = quality.get("scoring", {})

        def tuned(sensor: Sensor) -> Sensor:
            population = expected.get(sensor.column, {})
            return replace(
                sensor,
                low=float(quality.get(f"min_{sensor.column}", sensor.low)),
                high=float(quality.get(f"max_{sensor.column}", sensor.high)),
                mean=float(population.get("mean", sensor.mean)),
                stddev=float(population.get("stddev", sensor.stddev)),
            )

        given = {
            **_pick(scoring, anomaly_penalty="anomaly_penalty"),
            **_pick(quality, dedup_window_hours="dedup_window_hours"),
            **_pick(gold, window_duration="window_duration"),
            **_pick(
                gold.get("health_weights", {}),
                quality="quality_weight",
                anomaly_rate="anomaly_weight",
                battery="battery_weight",
            ),
            **_pick(
                gold.get("risk_tiers", {}),
                healthy="healthy_from",
                warning="warning_from",
            ),
            **_pick(
                gold.get("maintenance", {}),
                optimize_enabled="optimize_enabled",
                vacuum_enabled="vacuum_enabled",
                bronze_retention_hours="bronze_retention_hours",
                silver_retention_hours="silver_retention_hours",
                gold_retention_hours="gold_retention_hours",
            ),
            **_pick(
                config.get("streaming", {}),
                trigger_interval="trigger_interval",
                max_files_per_trigger="max_files_per_trigger",
                output_mode="output_mode",
            ),
        }
        if "optional_fields" in scoring:
            given["optional_fields"] = tuple(scoring["optional_fields"])
        return replace(base, sensors=tuple(tuned(s) for s in base.sensors), **given)


def _pick(section: Mapping, **names: str) -> dict:
    return {field: section[key] for key, field in names.items() if key in section}
