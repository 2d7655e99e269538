"""Shared session and small telemetry inputs."""

from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from telestrata import build_session  # noqa: E402
from telestrata.sources.landing import parse_lines  # noqa: E402

# A sample of this test suite: a quiet sensor in a hall.
DEFAULT_EVENT = {
    "device_id": "unit-07",
    "timestamp": "2024-11-05T10:00:00.000000+00:00",
    "temperature": 24.5,
    "humidity": 48.0,
    "pressure": 1003.25,
    "battery_level": 91.0,
    "location": "hall-3",
    "firmware_version": "2.4.1",
}


def event(minute: int = 0, **changes) -> dict:
    """The default event with changes; ``None`` leaves a field out."""
    hour = 10 + minute // 60
    stamp = f"2024-11-05T{hour:02d}:{minute % 60:02d}:00.000000+00:00"
    merged = {**DEFAULT_EVENT, "timestamp": stamp, **changes}
    return {k: v for k, v in merged.items() if v is not None}


def lines(*records) -> list[str]:
    return [r if isinstance(r, str) else json.dumps(r) for r in records]


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]",
        app_name="tests",
        shuffle_partitions=4,
        log_level="ERROR",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
    )
    yield session
    session.stop()


@pytest.fixture()
def frame(spark):
    """Parsed telemetry from events (dicts) and raw lines (strings)."""

    def build(*records):
        rows = spark.createDataFrame([(x,) for x in lines(*records)], "value string")
        return parse_lines(rows)

    return build


@pytest.fixture()
def land(tmp_path):
    """Write records as JSON files into a landing folder."""
    folder = tmp_path / "landing"
    folder.mkdir()

    def write(*records, name: str = "batch.json") -> str:
        (folder / name).write_text("\n".join(lines(*records)) + "\n")
        return str(folder)

    return write
