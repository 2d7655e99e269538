"""A feed made from the rules, a random feed, and Silver and Gold in plain Python to compare with."""

from __future__ import annotations

import json
import random
import statistics
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from telestrata.settings import DEFAULT_OPTIONAL_FIELDS, DEFAULT_SENSORS, KEY_COLUMNS, Settings
from tests.conftest import DEFAULT_EVENT, event

STEP = 0.25


def edge_feed() -> list:
    """Each limit with the values beside it, each field left out; some lines twice, some torn."""
    changes = [
        {s.column: limit + step}
        for s in DEFAULT_SENSORS
        for limit in (s.low, s.high)
        for step in (-STEP, 0.0, STEP)
    ]
    changes += [{name: None} for name in DEFAULT_EVENT]
    feed = []
    for i, change in enumerate(changes):
        record = event(i, **{"device_id": f"edge-{i:02d}", **change})
        feed += [record] * (1 + (i % 4 == 1))
        if i % 5 == 2:
            text = json.dumps(record)
            feed.append(text[: len(text) // 2])
    return feed


def random_feed(seed: int = 11, size: int = 240) -> list:
    """Four hours of a few devices, a third from one of them; gaps, repeats, one failing."""
    draw = random.Random(seed)
    feed = []
    for i in range(size):
        device = "busy" if i % 3 == 0 else f"node-{draw.randrange(5)}"
        failing = device == "node-0"
        readings = {"battery_level": draw.randrange(101 if failing else 401) * STEP}
        for s in DEFAULT_SENSORS:
            margin = (s.high - s.low) * (2 if failing else 0.05)
            readings[s.column] = round(draw.uniform(s.low - margin, s.high + margin) / STEP) * STEP
        readings = {c: v for c, v in readings.items() if draw.random() > 0.08}
        record = event(i, **dict.fromkeys(("battery_level", *(s.column for s in DEFAULT_SENSORS))), device_id=device)
        record |= readings
        feed += [record] * (1 + (draw.random() < 0.1))
    return feed


def _half_up(value: Decimal, places: int) -> float:
    return float(value.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def plain_silver(feed: list) -> list[dict]:
    """What Silver keeps and derives."""
    kept = {}
    for record in feed:
        if isinstance(record, dict) and all(k in record for k in KEY_COLUMNS):
            kept.setdefault(tuple(record[k] for k in KEY_COLUMNS), record)
    return [_derived({c: record.get(c) for c in DEFAULT_EVENT}) for record in kept.values()]


def _derived(row: dict) -> dict:
    filled = row["humidity"] is not None
    row["humidity"] = min(max(row["humidity"], 0.0), 100.0) if filled else 100.0
    flags = set()
    for s in DEFAULT_SENSORS:
        value = row[s.column]
        known = value is not None
        row[s.flag] = not s.low <= value <= s.high if known else None
        row[s.zscore] = _half_up((Decimal(value) - Decimal(s.mean)) / Decimal(s.stddev), 2) if known else None
        flags.add(row[s.flag])
    row["_is_anomaly"] = True if True in flags else None if None in flags else False
    share = Decimal(sum(row[c] is not None for c in DEFAULT_OPTIONAL_FIELDS)) / len(DEFAULT_OPTIONAL_FIELDS)
    penalty = Decimal("0.9") if row["_is_anomaly"] else 1
    row["_quality_score"] = _half_up(share * penalty, 4)
    return row


def plain_gold(silver: list[dict]) -> dict[tuple[str, int], dict]:
    """Figures per device and hour, not rounded."""
    groups = defaultdict(list)
    for row in silver:
        groups[row["device_id"], int(row["timestamp"][11:13])].append(row)
    return {key: _figures(rows) for key, rows in groups.items()}


def _figures(rows: list[dict]) -> dict:
    def known(column):
        return [r[column] for r in rows if r[column] is not None]

    temps, batteries = known("temperature"), known("battery_level")
    anomalies = sum(r["_is_anomaly"] is True for r in rows)
    quality = statistics.fmean(known("_quality_score"))
    battery = statistics.fmean(batteries) if batteries else None
    score = None
    if batteries:
        score = 0.4 * quality + 0.3 * (1 - anomalies / len(rows)) + 0.3 * battery / 100
    return {
        "n": len(rows),
        "temps": temps,
        "batteries": batteries,
        "z": [abs(z) for z in known("_temperature_zscore")],
        "kinds": tuple(sum(r[s.flag] is True for r in rows) for s in DEFAULT_SENSORS),
        "anomalies": anomalies,
        "rate": anomalies / len(rows),
        "quality": quality,
        "battery": battery,
        "score": score,
        "tier": plain_tier(score),
    }


def plain_tier(score: float | None, settings: Settings = Settings()) -> str:
    if score is None or score < settings.warning_from:
        return "critical"
    return "healthy" if score >= settings.healthy_from else "warning"
