"""Queries beyond plain batch and stream: batch layers, sessions, joins in time, sketches."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from telestrata.operators import distributions, sessions, sketches, temporal
from telestrata.plans.maintenance import maintain_batches
from telestrata.settings import Settings
from telestrata.sources import batches
from telestrata.sources.landing import parse_lines
from telestrata.sources.storage import delete_folder, workspace
from telestrata.streaming.jobs import start_bronze, start_silver
from telestrata.streaming.sinks import drained
from verification import queries as q
from verification.sql import bronze, cnt, gold, mean, rnd, silver

GAP = 3600  # seconds between sessions
HOURLY = 0.8  # health below which a window raises an alert


# Layers written batch by batch


def run_batches(spark, at: q.Folders, hours: float) -> None:
    drained(start_bronze(spark, at.landing, at.bronze, f"{at.state}/bronze", q.STREAM, True, by_batch=True))
    config = replace(q.STREAM, dedup_window_hours=hours)
    drained(start_silver(spark, at.bronze, at.silver, f"{at.state}/silver", config, True, by_batch=True))


def two_waves(spark, sf: str, name: str) -> tuple[q.Folders, int]:
    """Clicks and then the rest, through both layers; and the last Bronze batch of the first wave."""
    at, rows = q.Folders(spark, name), q.bronze(spark, sf)
    hours, first = q.hours_of(rows), F.col("location") == "click"
    q.arrive(rows.where(first), at)
    run_batches(spark, at, hours)
    last = max(s.last for s in batches.segments(spark, at.bronze))
    q.arrive(rows.where(~first), at)
    run_batches(spark, at, hours)
    return at, last


def batch_silver(spark, sf):
    """Silver of a batch layer, after its last batch ran a second time."""
    at, _ = two_waves(spark, sf, "batch-silver")
    last = max(s.last for s in batches.segments(spark, at.silver))
    delete_folder(spark, f"{at.state}/silver/commits/{last}")
    run_batches(spark, at, q.hours_of(q.bronze(spark, sf)))
    rows = q.without_zone(batches.read_batches(spark, at.silver))
    return rows.drop("_ingested_at", "_processed_at")


def batch_travel(spark, sf):
    """The first wave as a version, before and after compaction and retention."""
    at, last = two_waves(spark, sf, "batch-travel")
    count = lambda upto: batches.read_batches(spark, at.bronze, upto=upto).count()
    before = count(last), count(None)
    batches.compact_batches(spark, at.bronze)
    batches.expire_batches(spark, at.bronze, 1, datetime.now(timezone.utc) + timedelta(hours=2))
    after = count(last), count(None)
    rows = [("before", *before), ("after", *after)]
    return spark.createDataFrame(rows, "state string, first_wave bigint, all_waves bigint")


def batch_history(spark, sf):
    """Rows by operation; whether files and bytes agree with the listing."""
    at, _ = two_waves(spark, sf, "batch-history")

    def figures(state: str):
        return batches.batch_history(spark, at.bronze).agg(
            F.lit(state).alias("state"),
            F.sum("row_count").alias("row_count"),
            F.bool_and((F.col("num_files") > 0) & (F.col("num_bytes") > 0)).alias("all_measured"),
            (F.sum(F.col("last_batch") - F.col("first_batch") + 1) == F.max("last_batch") + 1).alias("all_batches_once"),
        )

    appended = figures("appended")
    batches.compact_batches(spark, at.bronze)
    # What was superseded stays until it expires, so both can still be read.
    return appended.unionByName(figures("compacted"))


def batch_maintain(spark, sf):
    settings = Settings(optimize_enabled=True, vacuum_enabled=True)
    at, _ = two_waves(spark, sf, "batch-maintain")
    layers = {"Bronze": at.bronze, "Silver": at.silver}
    maintain_batches(spark, layers, settings)
    later = datetime.now(timezone.utc) + timedelta(days=3650)
    done = maintain_batches(spark, layers, settings, now=later)
    left = None
    for layer, path in layers.items():
        one = batches.read_batches(spark, path).agg(F.count(F.lit(1)).alias("rows_left"))
        one = one.withColumn("layer", F.lit(layer)).withColumn("segments", F.lit(len(batches.segments(spark, path))))
        left = one if left is None else left.unionByName(one)
    kept = done.join(left, "layer").where("action = 'expire'")
    return kept.select("layer", "status", "rows_left", F.col("segments").cast("long").alias("segments"))


# Sessions


def device_sessions(spark, sf):
    return sessions.device_sessions(q.silver(spark, sf), GAP)


def session_stream(spark, sf):
    """Two halves in order of time; sessions that ended half the period before the last row."""
    at = q.Folders(spark, "session-stream")
    rows = q.silver(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    cut, hours = F.lit(q.middle_of(rows)), q.hours_of(rows, 0.5)
    for half in (F.col("timestamp") < cut, F.col("timestamp") >= cut):
        rows.where(half).write.mode("append").parquet(at.silver)
        source = spark.readStream.schema(rows.schema).parquet(at.silver)
        delay = f"{round(hours * 3600)} seconds"
        query = (
            sessions.device_sessions_stream(source, GAP, delay)
            .writeStream.format("parquet").option("path", at.gold)
            .option("checkpointLocation", f"{at.state}/sessions").trigger(availableNow=True).start()
        )
        drained(query)
    return q.without_zone(spark.read.parquet(at.gold))


# Joins in time


def asof_health(spark, sf):
    """Each reading with the last health row that was complete by then."""
    readings = q.silver(spark, sf).select("device_id", "timestamp", "temperature", "_quality_score")
    health = q.device_health(spark, sf).select(
        "device_id", F.col("window_end").alias("healthy_as_of"), "health_score", "risk_tier"
    )
    columns = ["healthy_as_of", "health_score", "risk_tier"]
    return temporal.asof_join(readings, health, "device_id", "timestamp", "healthy_as_of", columns)


def alert_readings(spark, sf):
    """Readings around alerts: half an hour before to an hour after, a day for critical ones."""
    readings = q.silver(spark, sf).select("device_id", "timestamp", "temperature")
    low = q.device_health(spark, sf).where(F.col("health_score") < HOURLY)
    alerts = low.select(
        "device_id",
        F.expr("window_start - interval 30 minutes").alias("alert_start"),
        F.expr("case when risk_tier = 'critical' then window_end + interval 1 day else window_end + interval 1 hour end").alias("alert_end"),
        "risk_tier",
    )
    return temporal.interval_join(
        readings, alerts, "device_id", "timestamp", "alert_start", "alert_end", ["alert_start", "alert_end", "risk_tier"]
    )


# Sketches and distributions


def daily_sketches(spark, sf):
    """Days merged from stored hours, next to exact figures: whether the bounds hold."""
    rows = q.silver(spark, sf)
    path = workspace(spark, "hourly-sketches")
    sketches.hourly_sketches(rows, "temperature").write.parquet(path)
    found = sketches.estimates(sketches.rolled_up(spark.read.parquet(path)), (0.5, 0.9))
    # One row per day and place.
    found = found.withColumnRenamed("devices", "estimated")
    day = F.date_trunc("day", "timestamp").alias("day")
    share = lambda p: F.avg((F.col("temperature") <= F.col(p)).cast("int"))
    least = lambda p: F.avg((F.col("temperature") < F.col(p)).cast("int"))
    exact = (
        rows.select(day, "location", "device_id", "temperature")
        .join(found, ["day", "location"])
        .groupBy("day", "location", "event_count", "estimated")
        .agg(
            F.count_distinct("device_id").alias("devices"),
            *[share(p).alias(f"{p}_high") for p in ("p50", "p90")],
            *[least(p).alias(f"{p}_low") for p in ("p50", "p90")],
        )
    )
    close = F.abs(F.col("estimated") - F.col("devices")) <= F.greatest(F.lit(1.0), F.col("devices") * sketches.DISTINCT_ERROR)
    ranks = F.lit(True)
    for p, rank in (("p50", 0.5), ("p90", 0.9)):
        fits = (F.col(f"{p}_low") <= rank + sketches.QUANTILE_ERROR) & (F.col(f"{p}_high") >= rank - sketches.QUANTILE_ERROR)
        ranks = ranks & F.coalesce(fits, F.lit(True))
    return q.without_zone(exact).select(
        "day", "location", "event_count", "devices", close.alias("devices_close"), ranks.alias("quantiles_close")
    )


def hist_battery_z(spark, sf):
    """Battery level by temperature z-score, of anomalous and other readings."""
    return distributions.histogram_2d(
        q.silver(spark, sf), ("battery_level", 10.0), ("_temperature_zscore", 2.0), by=("_is_anomaly",)
    )


def corrupt_kinds(spark, sf):
    """Clicks with a wrong type, views with a bad timestamp; all other lines are fine."""
    known = q.bronze(spark, sf).where("_corrupt_record is null")
    place = F.col("location")
    temperature = F.when(place == "click", F.lit('"hot"')).otherwise(F.coalesce(F.col("temperature").cast("string"), F.lit("null")))
    time = F.when(place == "view", F.lit("yesterday")).otherwise(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
    line = F.concat(
        F.lit('{"device_id": "'), F.coalesce("device_id", F.lit("")), F.lit('", "timestamp": "'), time,
        F.lit('", "location": "'), place, F.lit('", "temperature": '), temperature, F.lit("}"),
    )
    lines = known.where("timestamp is not null").select(line.alias("value"), place.alias("kind"))
    parsed = parse_lines(lines.select("value"))
    corrupt = parsed.where("_corrupt_record is not null").select(
        F.get_json_object("_corrupt_record", "$.location").alias("kind"), F.lit(1).alias("corrupt")
    )
    fine = parsed.where("_corrupt_record is null").select(F.col("location").alias("kind"), F.lit(0).alias("corrupt"))
    return corrupt.unionByName(fine).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum("corrupt").cast("long").alias("corrupt_rows")
    )


QUERIES = {
    "batch_silver": batch_silver,
    "batch_travel": batch_travel,
    "batch_history": batch_history,
    "batch_maintain": batch_maintain,
    "device_sessions": device_sessions,
    "session_stream": session_stream,
    "asof_health": asof_health,
    "alert_readings": alert_readings,
    "daily_sketches": daily_sketches,
    "hist_battery_z": hist_battery_z,
    "corrupt_kinds": corrupt_kinds,
}

SESSIONS = f"""
placed as (
  select *, sum(begins) over (partition by device_id order by timestamp rows unbounded preceding) as number from (
    select *, case when date_diff('microseconds', lag(timestamp) over (partition by device_id order by timestamp), timestamp)
      <= {GAP * 1_000_000} then 0 else 1 end as begins
    from silver)),
sessions as (
  select device_id, min(timestamp) as session_start, max(timestamp) as session_end, count(*) as event_count,
    {cnt('_is_anomaly')} as anomaly_count, {rnd(mean('_quality_score', 4), 4)} as avg_quality
  from placed group by device_id, number)
"""
CLOSED = (
    f"session_end + interval {GAP} seconds <= (select date_trunc('milliseconds', max(timestamp)) - to_seconds(cast(floor("
    "date_diff('microseconds', min(timestamp), max(timestamp)) / 2e6) as bigint) + 2) from silver)"
)
STATUS = "select '{0}' as layer, 'expired' as status, count(*) as rows_left, 1::bigint as segments from {1}"


def oracles() -> dict[str, str]:
    from verification.sql import SILVER_NO_CLOCK

    return {
        "batch_silver": silver(f"select {SILVER_NO_CLOCK} from silver"),
        "batch_travel": bronze(
            f"select state, {cnt("location = 'click'")} as first_wave, count(*) as all_waves "
            "from bronze, (values ('before'), ('after')) as s(state) group by state"
        ),
        "batch_history": bronze(
            "select state, count(*) as row_count, true as all_measured, true as all_batches_once "
            "from bronze, (values ('appended'), ('compacted')) as s(state) group by state"
        ),
        "batch_maintain": silver(f"{STATUS.format('Bronze', 'bronze')} union all {STATUS.format('Silver', 'silver')}"),
        "device_sessions": silver("select * from sessions", SESSIONS),
        "session_stream": silver(f"select * from sessions where {CLOSED}", SESSIONS),
        "asof_health": gold(
            "select s.device_id, s.timestamp, s.temperature, s._quality_score, h.window_end as healthy_as_of, "
            "h.health_score, h.risk_tier from silver s asof left join device_health h "
            "on s.device_id = h.device_id and s.timestamp >= h.window_end"
        ),
        "alert_readings": gold(
            "select s.device_id, s.timestamp, s.temperature, a.alert_start, a.alert_end, a.risk_tier from silver s join ("
            "select device_id, window_start - interval 30 minutes as alert_start, case when risk_tier = 'critical' "
            "then window_end + interval 1 day else window_end + interval 1 hour end as alert_end, risk_tier "
            f"from device_health where health_score < {HOURLY}) a "
            "on a.device_id = s.device_id and s.timestamp >= a.alert_start and s.timestamp < a.alert_end"
        ),
        "daily_sketches": silver(
            "select date_trunc('day', timestamp) as day, location, count(*) as event_count, "
            "count(distinct device_id) as devices, true as devices_close, true as quantiles_close "
            "from silver group by 1, 2"
        ),
        "hist_battery_z": silver(
            "select _is_anomaly, floor(battery_level / 10.0::double) * 10.0::double as battery_level_from, "
            "floor(_temperature_zscore / 2.0::double) * 2.0::double as _temperature_zscore_from, count(*) as n from silver "
            "where battery_level is not null and _temperature_zscore is not null group by all"
        ),
        "corrupt_kinds": bronze(
            f"select location as kind, count(*) as n, {cnt("location in ('click', 'view')")} as corrupt_rows "
            "from bronze where _corrupt_record is null and timestamp is not null group by 1"
        ),
    }
