"""Queries on baselines, subtotals, changes between versions, rescued fields and joined streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from telestrata.operators import changes, rolling, rollups
from telestrata.sources import snapshots
from telestrata.sources.landing import parse_lines
from telestrata.sources.storage import workspace
from telestrata.streaming.joins import acknowledged
from telestrata.streaming.sinks import drained
from verification import queries as q
from verification.sql import bronze, cnt, gold, mean, rnd, silver

DIMENSIONS = ("location", "firmware_version", "risk_tier")
FEWER = ("location", "risk_tier")
HIGH = 930.0  # pressure from which the rows of a later version differ
WITHIN = 6 * 3600  # seconds in which a reading is acknowledged


def baselines(spark, sf):
    """Each temperature against the last day of its device."""
    rows = q.silver(spark, sf).select("device_id", "timestamp", "temperature")
    found = rolling.rolling_baseline(rows, "temperature")
    return q.rounded(q.rounded(found, ["baseline_mean", "baseline_sd"]), ["baseline_z"], 4)


def tiered(spark, sf):
    rows, tables = q.once(spark, sf, DIMENSIONS[:2])
    return rollups.with_tiers(rows, tables["device_health"], DIMENSIONS[:2])


def tier_cube(spark, sf):
    return rollups.subtotals(tiered(spark, sf), DIMENSIONS)


def tier_sets(spark, sf):
    """Chosen subtotals only: by place and tier, by tier, and the total."""
    return rollups.subtotals(tiered(spark, sf), FEWER, [FEWER, FEWER[1:], ()])


def version_diff(spark, sf):
    """An append, then a rewrite that drops, changes and adds rows."""
    path = workspace(spark, "compared-table")
    columns = ("device_id", "timestamp", "temperature", "location")
    rows, place = q.bronze(spark, sf).where("_corrupt_record is null"), F.col("location")
    snapshots.commit(rows.where(place == "click").select(*columns), path, "append")
    snapshots.commit(rows.where(place == "view").select(*columns), path, "append")
    warmer = F.when(F.col("pressure") >= HIGH, F.col("temperature") + 1).otherwise(F.col("temperature"))
    later = rows.where(place.isin("click", "view", "purchase") & F.col("humidity").isNotNull())
    snapshots.commit(later.withColumn("temperature", warmer).select(*columns), path, "overwrite")
    steps = [
        changes.row_changes(*snapshots.unshared(spark, path, n, n + 1)).select(F.lit(name).alias("step"), "*")
        for n, name in enumerate(("append", "rewrite"))
    ]
    return steps[0].unionByName(steps[1])


def keyed_diff(spark, sf):
    rows = q.silver(spark, sf).select("device_id", "timestamp", "battery_level", "_quality_score", "pressure", "location")
    unlike = lambda kind: ~F.col("location").eqNullSafe(kind)
    old = rows.where(unlike("signup")).drop("pressure", "location")
    battery = F.when(F.col("pressure") >= HIGH, F.lit(50.0)).otherwise(F.col("battery_level"))
    quality = F.when(F.col("location") == "click", F.lit(0.5)).otherwise(F.col("_quality_score"))
    new = rows.where(unlike("error")).withColumns({"battery_level": battery, "_quality_score": quality})
    found = changes.keyed_changes(old, new.drop("pressure", "location"), ("device_id", "timestamp"))
    return found.withColumn("changed_columns", F.array_join("changed_columns", ","))


def rescued_fields(spark, sf):
    """Unknown fields, plain and nested, stored as a variant and read back by path."""
    known = q.bronze(spark, sf).where("_corrupt_record is null and timestamp is not null and location <> 'error'")
    rack = F.when(F.col("location") != "view", F.col("pressure") * 2)
    radio = F.when(F.col("location") == "click", F.struct(F.lit("n").alias("band"), F.array(F.lit(1), F.lit(7)).alias("cells")))
    shown = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    record = F.to_json(F.struct("device_id", "timestamp", "pressure", rack.alias("rack"), radio.alias("radio")), shown)
    path = workspace(spark, "rescued-fields")
    parse_lines(known.select(record.alias("value")), rescued="more").write.parquet(path)
    stored = spark.read.parquet(path)
    at = lambda place, kind: F.try_variant_get("more", f"$.{place}", kind)
    return q.without_zone(stored).select(
        "device_id", "timestamp", "pressure", at("rack", "double").alias("rack"), at("radio.band", "string").alias("band"),
        at("radio.cells[1]", "bigint").alias("cell"), F.col("more").isNull().alias("nothing_more"),
    )


def stream_acknowledged(spark, sf):
    """Anomalies and the clicks of their device within six hours, as two streams in two waves."""
    at = q.Folders(spark, "stream-acknowledged")
    rows = q.silver(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    alarms = rows.where("_is_anomaly").select("device_id", "timestamp", "_anomaly_details")
    acks = rows.where("location = 'click'").select(F.col("device_id").alias("ack_device"), F.col("timestamp").alias("ack_time"))
    hours = q.hours_of(rows, 0.5)
    cut = F.lit(q.middle_of(rows))
    # A last row on each side, late enough for everything before it to run out of time.
    end = F.max("timestamp") + F.make_dt_interval(secs=F.lit(round(hours * 3600) + WITHIN + 60))
    last = rows.agg(end.alias("timestamp"))
    waves = [
        (alarms.where(F.col("timestamp") < cut), acks.where(F.col("ack_time") < cut)),
        (alarms.where(F.col("timestamp") >= cut), acks.where(F.col("ack_time") >= cut)),
        (
            last.select(F.lit("end").alias("device_id"), "timestamp", F.lit(None).cast("string").alias("_anomaly_details")),
            last.select(F.lit("no").alias("ack_device"), F.col("timestamp").alias("ack_time")),
        ),
    ]
    for left, right in waves:
        left.write.mode("append").parquet(at.bronze)
        right.write.mode("append").parquet(at.silver)
        joined = acknowledged(
            spark.readStream.schema(alarms.schema).parquet(at.bronze),
            spark.readStream.schema(acks.schema).parquet(at.silver),
            f"{round(hours * 3600)} seconds", WITHIN,
        )
        drained(
            joined.writeStream.format("parquet").option("path", at.gold)
            .option("checkpointLocation", f"{at.state}/joined").trigger(availableNow=True).start()
        )
    done = spark.read.parquet(at.gold).where("device_id <> 'end'")
    return q.without_zone(done).select("device_id", "timestamp", "_anomaly_details", "ack_time")


QUERIES = {
    "baselines": baselines,
    "tier_cube": tier_cube,
    "tier_sets": tier_sets,
    "version_diff": version_diff,
    "keyed_diff": keyed_diff,
    "rescued_fields": rescued_fields,
    "stream_acknowledged": stream_acknowledged,
}

TIERED = (
    "tiered as (select s.location, s.firmware_version, h.risk_tier, s._is_anomaly, s._quality_score from silver s "
    "join device_health h on s.device_id = h.device_id "
    "and h.window_start = time_bucket(interval '1 hour', s.timestamp, timestamp '1970-01-01'))"
)
SUBTOTALS = (
    "select {0}, grouping({0}) as level, count(*) as events, "
    f"{cnt('_is_anomaly')} as anomalies, {rnd(f'cast({cnt("_is_anomaly")} as double) / count(*)', 4)} as anomaly_rate, "
    f"{rnd(mean('_quality_score', 4), 4)} as avg_quality from tiered group by "
)
LESS = "select '{0}' as step, '{1}' as change, count(*) as copies, * from (select * from {2} except all select * from {3}) group by all"


def oracles() -> dict[str, str]:
    shown = "device_id, timestamp, temperature, location"
    warmer = f"device_id, timestamp, case when pressure >= {HIGH} then temperature + 1 else temperature end as temperature, location"
    fine = "from bronze where _corrupt_record is null and location"
    spread = "sqrt(cast(n * q - s * s as double) / (cast(n as double) * (n - 1)))"
    return {
        "baselines": silver(
            "select device_id, timestamp, temperature, n as baseline_n, "
            f"{rnd('centre / 100', 6)} as baseline_mean, {rnd('sd / 100', 6)} as baseline_sd, "
            f"case when sd > 0 then {rnd('(x - centre) / sd', 4)} end as baseline_z from measured",
            "scaled as (select *, cast(round(temperature * 100) as hugeint) as x from silver)",
            "summed as (select *, count(x) over past as n, sum(x) over past as s, sum(x * x) over past as q from scaled "
            "window past as (partition by device_id order by timestamp "
            "range between interval 24 hours preceding and interval 1 microsecond preceding))",
            f"measured as (select *, cast(s as double) / nullif(n, 0) as centre, case when n > 1 then {spread} end as sd from summed)",
        ),
        "tier_cube": gold(f"{SUBTOTALS} cube ({{0}})".format(", ".join(DIMENSIONS)), TIERED),
        "tier_sets": gold(f"{SUBTOTALS} grouping sets (({{0}}), (risk_tier), ())".format(", ".join(FEWER)), TIERED),
        "version_diff": bronze(
            f", v0 as (select {shown} {fine} = 'click'), v1 as (select {shown} {fine} in ('click', 'view')), "
            f"v2 as (select {warmer} {fine} in ('click', 'view', 'purchase') and humidity is not null) "
            + " union all ".join(LESS.format(*x) for x in (
                ("append", "added", "v1", "v0"), ("rewrite", "added", "v2", "v1"), ("rewrite", "removed", "v1", "v2")))
        ),
        "keyed_diff": silver(
            "select coalesce(o.device_id, n.device_id) as device_id, coalesce(o.timestamp, n.timestamp) as timestamp, "
            "case when o.device_id is null then 'added' when n.device_id is null then 'removed' else 'changed' end as change, "
            "case when o.device_id is not null and n.device_id is not null then concat_ws(',', "
            "case when o.b is distinct from n.b then 'battery_level' end, "
            "case when o.q is distinct from n.q then '_quality_score' end) end as changed_columns "
            "from o full join n on o.device_id = n.device_id and o.timestamp = n.timestamp "
            "where o.device_id is null or n.device_id is null or o.b is distinct from n.b or o.q is distinct from n.q",
            "o as (select device_id, timestamp, battery_level as b, _quality_score as q from silver where location is distinct from 'signup')",
            f"n as (select device_id, timestamp, case when pressure >= {HIGH} then 50 else battery_level end as b, "
            "case when location = 'click' then 0.5 else _quality_score end as q from silver where location is distinct from 'error')",
        ),
        "rescued_fields": bronze(
            "select device_id, timestamp, pressure, case when location <> 'view' then pressure * 2 end as rack, "
            "case when location = 'click' then 'n' end as band, case when location = 'click' then 7::bigint end as cell, "
            "location = 'view' or (pressure is null and location <> 'click') as nothing_more from bronze "
            "where _corrupt_record is null and timestamp is not null and location <> 'error'"
        ),
        "stream_acknowledged": silver(
            "select a.device_id, a.timestamp, a._anomaly_details, k.timestamp as ack_time from silver a "
            "left join (select * from silver where location = 'click') k on a.device_id = k.device_id "
            f"and k.timestamp >= a.timestamp and k.timestamp <= a.timestamp + interval {WITHIN} seconds where a._is_anomaly"
        ),
    }
