"""Names that the queries and their SQL share."""

MODEL_LABEL = "is_anomalous_window"

_PER_SENSOR = ("mean", "stddev", "min", "max", "range")
_SENSORS = ("temp", "hum", "pres")
FEATURES = (
    ["event_count"]
    + [f"{s}_{m}" for s in _SENSORS for m in _PER_SENSOR]
    + [f"battery_{m}" for m in ("mean", "min", "max")]
    + ["anomaly_count", "anomaly_rate"]
    + [f"{s}_anomaly_count" for s in _SENSORS]
    + ["quality_mean", "quality_min"]
    + [f"{s}_zscore_abs_{m}" for s in _SENSORS for m in ("mean", "max")]
)
