"""Device-telemetry analytics in three layers, written as Spark jobs."""

from telestrata.settings import Sensor, Settings
from telestrata.session import build_session

__all__ = ["Sensor", "Settings", "build_session"]
