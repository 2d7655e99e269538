"""Session defaults for batch and streaming jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps event times and windows equal on every machine; the RocksDB state
# store keeps deduplication state off the JVM heap. Recording the Python call site
# of every expression costs more than it tells in plans this wide.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "telestrata",
    shuffle_partitions: int | None = None,
    log_level: str = "WARN",
    **conf: str,
) -> SparkSession:
    """Create or reuse a session. ``conf`` keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark
