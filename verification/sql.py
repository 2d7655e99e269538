"""The registered queries once more, as SQL for DuckDB on the same tables.

Two recipes make the engines agree. Rounding: Spark rounds the shortest decimal
text of a double half up, so ``rnd`` goes through text. Means of rounded columns:
``mean`` adds the last decimal place as integers, which no order of addition can
change.
"""

from __future__ import annotations

from verification.names import FEATURES, MODEL_LABEL

RAW = (
    "device_id, timestamp, temperature, humidity, pressure, battery_level, "
    "location, firmware_version"
)
# Fixed values, as in the settings of the library.
SENSORS = (
    # column, short, label, low, high, mean, stddev
    ("temperature", "temp", "temp", -50, 150, 22.0, 5.0),
    ("humidity", "hum", "humidity", 0, 100, 55.0, 10.0),
    ("pressure", "pres", "pressure", 900, 1100, 1013.25, 10.0),
)


def rnd(x: str, n: int) -> str:
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,20)), {n}) as double)"


def mean(x: str, places: int) -> str:
    scale = 10**places
    return (
        f"(cast(sum(cast(round({x} * {scale}) as bigint)) as double)"
        f" / nullif(count({x}) * {scale}, 0))"
    )


def cnt(condition: str) -> str:
    return f"count(*) filter (where {condition})"


BASE = """
base as (
  select event_id,
    case when event_id % 53 <> 0
         then concat('device-', lpad(cast(user_id as varchar), 4, '0')) end as device_id,
    ts as timestamp,
    case when event_type <> 'signup' then value - cast(60 as double) end as temperature,
    case when event_id % 11 <> 0 then value - cast(20 as double) end as humidity,
    cast(880 as double) + value as pressure,
    case when event_id % 13 <> 0
         then cast(json_extract_string(props, '$.k') as double) end as battery_level,
    event_type as location,
    case when event_type <> 'error' then '1.0.0' end as firmware_version,
    case when event_id % 97 = 0
         then concat('not json ', cast(event_id as varchar)) end as _corrupt_record,
    ts + to_seconds(event_id % 600) as _ingested_at,
    concat('landing/', strftime(ts, '%Y-%m-%d')) as _source_file
  from events),
bronze as (select * from base union all select * from base where event_id % 10 = 0)
"""

RAW_FLAGS = ", ".join(
    f"({c} > {high} or {c} < {low}) as _is_{label}_anomaly"
    for c, _, label, low, high, _, _ in SENSORS
)
ANY = "(_is_temp_anomaly or _is_humidity_anomaly or _is_pressure_anomaly)"
DETAILS = (
    f"case when {ANY} then concat_ws(', ', "
    + ", ".join(
        f"case when _is_{label}_anomaly then '{c}_out_of_range' end"
        for c, _, label, *_ in SENSORS
    )
    + ") end"
)
ZSCORES = ", ".join(
    f"{rnd(f'({c} - {m}) / cast({sd} as double)', 2)} as _{c}_zscore"
    for c, _, _, _, _, m, sd in SENSORS
)
FILLED = " + ".join(
    f"cast({c} is not null as int)"
    for c in (
        "temperature",
        "humidity",
        "pressure",
        "battery_level",
        "location",
        "firmware_version",
    )
)
QUALITY = rnd(
    f"(({FILLED}) / cast(6 as double))"
    " * (case when _is_anomaly then cast(0.9 as double) else cast(1 as double) end)",
    4,
)

SILVER = f"""
deduplicated as (
  select * from bronze
  where _corrupt_record is null and device_id is not null and timestamp is not null
  qualify row_number() over (partition by device_id, timestamp order by event_id) = 1),
clamped as (
  select * replace (greatest(cast(0 as double), least(cast(100 as double), humidity))
                    as humidity) from deduplicated),
flagged as (select *, {RAW_FLAGS} from clamped),
tagged as (select *, {ANY} as _is_anomaly, {DETAILS} as _anomaly_details from flagged),
silver as (
  select {RAW}, _ingested_at, _is_temp_anomaly, _is_humidity_anomaly,
    _is_pressure_anomaly, _is_anomaly, _anomaly_details, {ZSCORES},
    {QUALITY} as _quality_score,
    _ingested_at + to_seconds(cast(second(timestamp) as bigint) + 1) as _processed_at
  from tagged)
"""


def stats(name: str, window: str) -> str:
    measures = [
        "count(*) as n",
        f"{cnt('_is_anomaly')} as any_n",
        "avg(battery_level) as battery_mean",
        "min(battery_level) as battery_min",
        "max(battery_level) as battery_max",
        f"{mean('_quality_score', 4)} as quality_mean",
        "min(_quality_score) as quality_min",
    ]
    for c, short, label, *_ in SENSORS:
        measures += [
            f"avg({c}) as {short}_mean",
            f"stddev_samp({c}) as {short}_sd",
            f"min({c}) as {short}_min",
            f"max({c}) as {short}_max",
            f"{cnt(f'_is_{label}_anomaly')} as {short}_n",
            f"{mean(f'abs(_{c}_zscore)', 2)} as {short}_z_mean",
            f"max(abs(_{c}_zscore)) as {short}_z_max",
        ]
    start = f"time_bucket(interval '{window}', timestamp, timestamp '1970-01-01')"
    return (
        f"{name} as (select device_id, {start} as window_start, "
        f"{start} + interval '{window}' as window_end, {', '.join(measures)} "
        f"from silver group by all)"
    )


RATE = "(cast(any_n as double) / n)"
HEALTH = (
    "0.4::double * quality_mean + 0.3::double * (1.0::double - "
    + RATE
    + ") + 0.3::double * (battery_mean / 100.0::double)"
)


def device_summary(source: str) -> str:
    means = {
        "avg_temperature": "temp_mean",
        "stddev_temperature": "temp_sd",
        "min_temperature": "temp_min",
        "max_temperature": "temp_max",
        "avg_humidity": "hum_mean",
        "avg_pressure": "pres_mean",
        "avg_battery_level": "battery_mean",
    }
    return (
        "select device_id, window_start, window_end, n as event_count, "
        + ", ".join(f"{rnd(x, 2)} as {a}" for a, x in means.items())
        + f", any_n as anomaly_count, {rnd(RATE, 4)} as anomaly_rate, "
        f"{rnd('quality_mean', 4)} as avg_quality_score from {source}"
    )


def anomaly_summary(source: str) -> str:
    return f"""select device_id, window_start, window_end, n as total_events,
      temp_n as temp_anomaly_count, hum_n as humidity_anomaly_count,
      pres_n as pressure_anomaly_count, any_n as total_anomaly_count,
      {rnd(RATE, 4)} as anomaly_rate from {source}"""


def device_health(source: str) -> str:
    return f"""select device_id, window_start, window_end, n as event_count,
      {rnd('quality_mean', 4)} as avg_quality_score, {rnd(RATE, 4)} as anomaly_rate,
      {rnd('battery_mean', 2)} as avg_battery_level, health_score,
      case when health_score >= 0.8 then 'healthy' when health_score >= 0.5 then 'warning'
           else 'critical' end as risk_tier
      from (select *, {rnd(HEALTH, 4)} as health_score from {source})"""


def ml_features(source: str) -> str:
    cols = ["n as event_count"]
    for _, s, *_ in SENSORS:
        cols += [
            f"{rnd(f'{s}_mean', 4)} as {s}_mean",
            f"{rnd(f'{s}_sd', 4)} as {s}_stddev",
            f"{rnd(f'{s}_min', 4)} as {s}_min",
            f"{rnd(f'{s}_max', 4)} as {s}_max",
            f"{rnd(rnd(f'{s}_max', 4) + ' - ' + rnd(f'{s}_min', 4), 4)} as {s}_range",
        ]
    cols += [f"{rnd(f'battery_{m}', 4)} as battery_{m}" for m in ("mean", "min", "max")]
    cols += ["any_n as anomaly_count", f"{rnd(RATE, 4)} as anomaly_rate"]
    cols += [f"{s}_n as {s}_anomaly_count" for _, s, *_ in SENSORS]
    cols += [f"{rnd(f'quality_{m}', 4)} as quality_{m}" for m in ("mean", "min")]
    for _, s, *_ in SENSORS:
        cols += [f"{rnd(f'{s}_z_{m}', 4)} as {s}_zscore_abs_{m}" for m in ("mean", "max")]
    return f"select device_id, window_start, window_end, {', '.join(cols)} from {source}"


GOLD = f"""
{stats('stats', '1 hour')},
device_summary as ({device_summary('stats')}),
anomaly_summary as ({anomaly_summary('stats')}),
device_health as ({device_health('stats')}),
ml_features as ({ml_features('stats')})
"""
ROLLUP = f"""
per_device as (
  select device_id, {mean('health_score', 4)} as avg_health, min(health_score) as min_health,
    {mean('anomaly_rate', 4)} as avg_anomaly_rate,
    {mean('avg_battery_level', 2)} as avg_battery,
    {mean('avg_quality_score', 4)} as avg_quality,
    {cnt("risk_tier = 'critical'")} as c, {cnt("risk_tier = 'healthy'")} as h,
    {cnt("risk_tier = 'warning'")} as w
  from device_health group by device_id),
rollup_t as (
  select * exclude (c, h, w),
    case when c >= h and c >= w then 'critical' when h >= w then 'healthy'
         else 'warning' end as risk_tier
  from per_device)
"""
LATENCY = """
latency as (
  select device_id, _ingested_at, _processed_at,
    date_diff('second', _ingested_at, _processed_at) as _latency_sec,
    _quality_score, _is_anomaly
  from silver)
"""


def bronze(select: str) -> str:
    return f"with {BASE} {select}"


def silver(select: str, *more: str) -> str:
    return f"with {', '.join((BASE, SILVER, *more))} {select}"


def gold(select: str, *more: str) -> str:
    return silver(select, GOLD, *more)


def components(quality: str, rate: str, battery: str) -> str:
    return f"""{rnd(f'0.4::double * {quality}', 6)} as quality_component,
      {rnd(f'0.3::double * (1.0::double - {rate})', 6)} as anomaly_component,
      {rnd(f'0.3::double * ({battery} / 100.0::double)', 6)} as battery_component"""


def hist(source: str, value: str, width: float, by: str = "") -> str:
    bucket = f"cast(floor({value} / cast({width} as double)) as bigint)"
    return (
        f"select {by}{bucket} as bucket, count(*) as n, "
        f"{bucket} * cast({width} as double) as bucket_low "
        f"from {source} where {value} is not null group by all"
    )


def stacked(triples: list[tuple[str, str, str]], source: str = "silver") -> str:
    return "(" + " union all ".join(
        f"select '{name}' as sensor, {value} as value, {flag} as flag from {source}"
        for name, value, flag in triples
    ) + ")"


def long_features(names) -> str:
    return "(" + " union all ".join(
        f"select '{c}' as feature, cast({c} as double) as value from ml_features"
        for c in names
    ) + ")"


def agreement() -> str:
    parts = stacked(
        [
            (
                c,
                f"coalesce(abs(_{c}_zscore) > 3, false)",
                f"coalesce(_is_{label}_anomaly, false)",
            )
            for c, _, label, *_ in SENSORS
        ]
    )
    return (
        f"select sensor, {cnt('value and flag')} as both, "
        f"{cnt('value and not flag')} as z_only, {cnt('not value and flag')} as rule_only, "
        f"{cnt('not value and not flag')} as neither from {parts} group by sensor"
    )


def correlation() -> str:
    def one(a: str) -> str:
        pairs = ", ".join(
            f"case when var_pop(case when {b} is not null then {a}::double end) > 0 and "
            f"var_pop(case when {a} is not null then {b}::double end) > 0 "
            f"then {rnd(f'corr({a}::double, {b}::double)', 6)} end as \"{b}\""
            for b in FEATURES
        )
        return f"select '{a}' as feature, {pairs} from ml_features"

    rows = " union all ".join(one(a) for a in FEATURES)
    return (
        f"select feature, other, correlation from ({rows}) "
        f"unpivot include nulls (correlation for other in ({', '.join(FEATURES)}))"
    )


def fill_counts(source: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, count({c}) as filled from {source}" for c in columns
    )


BRONZE_COLUMNS = [*RAW.split(", "), "_corrupt_record", "_ingested_at", "_source_file"]
SILVER_COLUMNS = [
    *RAW.split(", "),
    "_ingested_at",
    "_is_temp_anomaly",
    "_is_humidity_anomaly",
    "_is_pressure_anomaly",
    "_is_anomaly",
    "_anomaly_details",
    "_temperature_zscore",
    "_humidity_zscore",
    "_pressure_zscore",
    "_quality_score",
    "_processed_at",
]


def verdicts(rows: list[tuple[str, str, str, str, str]]) -> str:
    """check, layer, observed, condition, expected."""
    return " union all ".join(
        f"select '{check}' as \"check\", '{layer}' as layer, "
        f"case when coalesce({passed}, false) then 'pass' else 'fail' end as status, "
        f"cast({observed} as double) as observed, '{expected}' as expected from m"
        for check, layer, observed, passed, expected in rows
    )


def measured(**measures: str) -> str:
    return "m as (select " + ", ".join(f"({sql}) as {k}" for k, sql in measures.items()) + ")"


PARSED = "case when _corrupt_record is null then {0} end as {0}"
AS_PARSED = ", ".join(PARSED.format(c) for c in RAW.split(", ")) + ", _corrupt_record"
SILVER_NO_CLOCK = ", ".join(
    c for c in SILVER_COLUMNS if c not in ("_ingested_at", "_processed_at")
)
LATE = """
usable as (select timestamp from bronze where _corrupt_record is null and device_id is not null),
cut as (select date_trunc('milliseconds', max(timestamp)) - interval 24 hours as edge from usable)
"""
# The split of the model: leading hash digits of the window's key and the seed.
LABELLED = f"""
labelled as (
  select *, cast(anomaly_rate > 0 as int) as {MODEL_LABEL},
    case when cast(concat('0x', substr(md5(concat_ws('|', device_id,
      strftime(window_start, '%Y-%m-%d %H:%M:%S'), '42')), 1, 8)) as bigint) % 1000000 < 700000
      then 'train' else 'test' end as side
  from ml_features)
"""
RULE_SCORED = """
scored as (
  select *, cast(predicted_prob > 0.1 as int) as predicted_anomalous from (
    select *, least(1.0::double, coalesce(temp_zscore_abs_max, 0) / 20.0::double) as predicted_prob
    from labelled where side = 'test'))
"""
ROC = f"""
roc as (
  select predicted_prob as threshold,
    sum(neg) over above / all_neg as fpr, sum(pos) over above / all_pos as tpr,
    neg / all_neg as fpr_step, pos / all_pos as tpr_step
  from (
    select *, sum(pos) over () as all_pos, sum(neg) over () as all_neg from (
      select predicted_prob, cast(count(*) filter (where {MODEL_LABEL} = 1) as double) as pos,
        cast(count(*) filter (where {MODEL_LABEL} = 0) as double) as neg
      from scored group by 1))
  window above as (order by predicted_prob desc))
"""
LEAKING = (
    "anomaly_count", "anomaly_rate", "temp_anomaly_count", "hum_anomaly_count", "pres_anomaly_count"
)


def _category(feature: str) -> str:
    """The first part of a name that tells its category."""
    parts = (
        ("zscore", "Z-Score Features"), ("quality", "Quality Features"), ("battery", "Battery Features"),
        ("temp", "Temperature Sensor"), ("hum", "Humidity Sensor"), ("pres", "Pressure Sensor"),
    )
    return next((name for part, name in parts if part in feature), "Other")


def _over(part: str, whole: str) -> str:
    return f"coalesce(cast({part} as double) / nullif({whole}, 0), 0)"


REPEATED = (
    "select count(*) from (select 1 from {0} group by device_id, {1} having count(*) > 1)"
)


def oracles() -> dict[str, str]:
    return {
        "parse_telemetry": bronze(f"select {AS_PARSED} from bronze"),
        "corrupt_capture": bronze(
            "select _corrupt_record from bronze where _corrupt_record is not null"
        ),
        "ingest_metadata": bronze(
            "select count(*) as total_rows, count(*) as stamped_rows, "
            "count(*) as rows_with_file from bronze"
        ),
        "drop_corrupt": bronze(
            f"select {RAW}, _ingested_at, _source_file from bronze "
            "where _corrupt_record is null"
        ),
        "drop_nulls": bronze(
            f"select {', '.join(BRONZE_COLUMNS)} from bronze "
            "where device_id is not null and timestamp is not null"
        ),
        "dedup": bronze(
            f"select {', '.join(BRONZE_COLUMNS)} from bronze qualify row_number() over "
            "(partition by device_id, timestamp order by event_id) = 1"
        ),
        "dedup_first": bronze(
            f"select {', '.join(BRONZE_COLUMNS)} from bronze qualify row_number() over "
            "(partition by device_id, timestamp order by _ingested_at, event_id) = 1"
        ),
        "normalize": bronze(
            "select device_id, timestamp, "
            "greatest(0.0::double, least(100.0::double, humidity)) as humidity, "
            "case when humidity is not null then "
            "greatest(0.0::double, least(100.0::double, humidity)) end as humidity_null_safe "
            "from bronze"
        ),
        "tag_anomalies": bronze(
            f"select *, {ANY} as _is_anomaly, {DETAILS} as _anomaly_details from "
            f"(select {RAW}, {RAW_FLAGS} from bronze)"
        ),
        "zscores": bronze(f"select device_id, timestamp, {ZSCORES} from bronze"),
        "quality_score": bronze(
            f"select device_id, timestamp, _is_anomaly, {QUALITY} as _quality_score from "
            f"(select *, {ANY} as _is_anomaly from (select *, {RAW_FLAGS} from bronze))"
        ),
        "silver": silver("select * from silver"),
        "anomaly_slice": silver(
            "select case when _is_anomaly then 'anomalous' else 'clean' end as slice, "
            "device_id, timestamp, _anomaly_details, _quality_score "
            "from silver where _is_anomaly is not null"
        ),
        "latency": silver("select * from latency", LATENCY),
        "device_summary": gold("select * from device_summary"),
        "device_summary_30m": silver(device_summary("s"), stats("s", "30 minutes")),
        "device_summary_2h": silver(device_summary("s"), stats("s", "2 hours")),
        "anomaly_summary": gold("select * from anomaly_summary"),
        "device_health": gold("select * from device_health"),
        "ml_features": gold("select * from ml_features"),
        "bronze_profile": bronze(
            "select count(*) as total_rows, count(_corrupt_record) as corrupt_records, "
            "count(distinct device_id) as distinct_devices, "
            "count(distinct _source_file) as source_files, "
            "min(_ingested_at) as earliest_ingestion, max(_ingested_at) as latest_ingestion "
            "from bronze"
        ),
        "numeric_ranges": bronze(
            "select "
            + ", ".join(
                f"min({c}) as {s}_min, max({c}) as {s}_max, {rnd(f'avg({c})', 6)} as {s}_avg"
                for s, c in (
                    ("temp", "temperature"),
                    ("hum", "humidity"),
                    ("pres", "pressure"),
                    ("batt", "battery_level"),
                )
            )
            + " from bronze"
        ),
        "silver_profile": silver(
            "select count(*) as total_rows, count(distinct device_id) as distinct_devices, "
            f"{cnt('_is_anomaly')} as anomaly_count, "
            f"{mean('_quality_score', 4)} as avg_quality_score, "
            "min(_quality_score) as min_quality_score from silver"
        ),
        "anomaly_breakdown": silver(
            "select "
            + ", ".join(
                f"cast(sum(cast(_is_{label}_anomaly as int)) as bigint) as {c}_anomalies"
                for c, _, label, *_ in SENSORS
            )
            + ", cast(sum(cast(_is_anomaly as int)) as bigint) as total_anomalies from silver"
        ),
        "layer_funnel": gold(
            f"""select position, layer, column_count, row_count,
              {rnd('cast(row_count as double) / first_count', 4)} as share_of_first,
              before - row_count as rows_dropped,
              {rnd('cast(before - row_count as double) / before', 4)} as drop_rate
            from (select *, coalesce(lag(row_count) over (order by position), row_count) as before,
                    first_value(row_count) over (order by position) as first_count
                  from (select 0 as position, 'bronze' as layer, 11 as column_count, count(*) as row_count from bronze
                  union all select 1, 'silver', 19, count(*) from silver
                  union all select 2, 'device_summary', 14, count(*) from device_summary
                  union all select 3, 'anomaly_summary', 9, count(*) from anomaly_summary
                  union all select 4, 'device_health', 9, count(*) from device_health
                  union all select 5, 'ml_features', 35, count(*) from ml_features))"""
        ),
        "dq_summary": gold(
            f"""select 'bronze' as layer, 'total_records' as metric, count(*)::double as value from bronze
            union all select 'bronze', 'corrupt_records', count(_corrupt_record) from bronze
            union all select 'bronze', 'null_key_records',
              {cnt('device_id is null or timestamp is null')} from bronze
            union all select 'silver', 'clean_records', count(*) - {cnt('_is_anomaly')} from silver
            union all select 'silver', 'anomalous_records', {cnt('_is_anomaly')} from silver
            union all select 'silver', 'avg_quality_score',
              {rnd(mean('_quality_score', 4), 4)} from silver
            union all select 'gold', 'aggregate_rows', 4 * count(*) from stats"""
        ),
        "schema_diff": silver(
            f"""select coalesce(b.column_name, s.column_name) as column_name,
              case when b.column_name is null then 'added'
                   when s.column_name is null then 'dropped' else 'kept' end as change,
              coalesce(b.filled, 0) as filled_before, coalesce(s.filled, 0) as filled_after
            from ({fill_counts('bronze', BRONZE_COLUMNS)}) b
            full outer join ({fill_counts('silver', SILVER_COLUMNS)}) s
              on b.column_name = s.column_name"""
        ),
        "device_anomaly_rate": silver("select * from rates", RATES),
        "anomaly_by_device": gold(
            """select device_id, cast(sum(temp_anomaly_count) as bigint) as temp_anomaly_count,
              cast(sum(humidity_anomaly_count) as bigint) as humidity_anomaly_count,
              cast(sum(pressure_anomaly_count) as bigint) as pressure_anomaly_count,
              cast(sum(total_anomaly_count) as bigint) as total_anomaly_count
            from anomaly_summary group by device_id having sum(total_anomaly_count) > 0"""
        ),
        "device_abs_z": silver(f"select * from ({DEVICE_Z})"),
        "z_rule_agreement": silver(agreement()),
        "anomaly_per_minute": silver(
            f"""select *, cast(anomaly_count as double) / nullif(total_events, 0) as anomaly_rate
            from (select date_trunc('minute', timestamp) as minute,
              count(_is_anomaly) as total_events, {cnt('_is_anomaly')} as anomaly_count,
              {cnt('_is_temp_anomaly')} as temp_anom, {cnt('_is_humidity_anomaly')} as hum_anom,
              {cnt('_is_pressure_anomaly')} as pres_anom from silver group by 1)"""
        ),
        "battery_split": silver(
            f"""select case when battery_level < 30 then 'low' else 'healthy' end as battery_group,
              count(*) as events, {cnt('_is_anomaly')} as anomalies,
              cast({cnt('_is_anomaly')} as double) / nullif(count(_is_anomaly), 0) as anomaly_rate
            from silver where battery_level is not null group by 1"""
        ),
        "hist_sensor": silver(
            hist(
                "(select sensor, value, case when flag then 'out_of_range' else 'in_range' end "
                "as class from "
                + stacked([(c, c, f"_is_{label}_anomaly") for c, _, label, *_ in SENSORS])
                + " where flag is not null)",
                "value",
                10,
                "sensor, class, ",
            )
        ),
        "hist_zscore": silver(
            hist(
                "(select sensor, value, case when flag then 'anomalous' else 'clean' end "
                "as class from "
                + stacked(
                    [(c, f"_{c}_zscore", "coalesce(_is_anomaly, false)") for c, *_ in SENSORS]
                )
                + ")",
                "value",
                0.5,
                "sensor, class, ",
            )
        ),
        "hist_quality": silver(
            hist(
                "(select _quality_score as value, case when _is_anomaly then 'anomalous' "
                "else 'clean' end as class from silver where _is_anomaly is not null)",
                "value",
                0.05,
                "class, ",
            )
        ),
        "hist_health": gold(hist("device_health", "health_score", 0.05, "risk_tier, ")),
        "hist_latency": silver(hist("latency", "_latency_sec", 5), LATENCY),
        "hist_features": gold(
            hist(long_features(FEATURES), "value", 0.5, "feature, ")
        ),
        "risk_tiers": gold(
            "select risk_tier, count(*) as n, cast(count(*) as double) / "
            "sum(count(*)) over () as share from device_health group by risk_tier"
        ),
        "device_rollup": gold("select * from rollup_t", ROLLUP),
        "health_stats": gold(
            f"select {mean('health_score', 4)} as mean_health, min(health_score) as min_health, "
            "max(health_score) as max_health from device_health"
        ),
        "kpis": gold(
            f"""select 'total_anomalies' as kpi, sum(total_anomaly_count)::double as value
              from anomaly_summary
            union all select 'avg_health', {mean('health_score', 4)} from device_health
            union all select 'critical_windows', {cnt("risk_tier = 'critical'")} from device_health
            union all select 'median_latency_sec', median(_latency_sec)::double from latency""",
            LATENCY,
        ),
        "health_decomposition": gold(
            f"select device_id, avg_health, risk_tier, "
            f"{components('avg_quality', 'avg_anomaly_rate', 'avg_battery')} "
            "from rollup_t order by avg_health asc nulls last, device_id limit 10",
            ROLLUP,
        ),
        "feature_describe": gold(
            f"select feature, count(value) as count, {rnd('avg(value)', 6)} as mean, "
            f"{rnd('stddev_samp(value)', 6)} as std, min(value) as min, max(value) as max "
            f"from {long_features(FEATURES)} group by feature"
        ),
        "feature_corr": gold(correlation()),
        "top_devices": gold(
            "select * from device_summary "
            "order by event_count desc, device_id, window_start limit 20"
        ),
        "top_anomaly_rate": silver(
            "select * from rates order by anomaly_rate desc nulls last, device_id limit 20",
            RATES,
        ),
        "top_abs_z": silver(
            f"select * from ({DEVICE_Z}) "
            "order by avg_abs_temperature_z desc nulls last, device_id limit 20"
        ),
        "lowest_health": gold(
            f"select *, {components('avg_quality_score', 'anomaly_rate', 'avg_battery_level')} "
            "from device_health order by health_score asc nulls last, device_id, window_start "
            "limit 10"
        ),
        "features_health": gold(
            "select f.*, h.health_score, h.risk_tier from ml_features f "
            "left join device_health h using (device_id, window_start)"
        ),
        "health_trend": gold(
            "select device_id, window_start, health_score, risk_tier from device_health "
            "where device_id in (select device_id from rollup_t "
            "order by avg_health asc nulls last, device_id limit 5)",
            ROLLUP,
        ),
        "check_counts": gold(
            verdicts(
                [
                    ("row_count", "bronze", "b", "b >= 1", ">= 1"),
                    ("row_count", "silver", "s", "s >= 1", ">= 1"),
                    ("row_count", "device_summary", "d", "d >= 1", ">= 1"),
                    ("row_count", "ml_features", "f", "f >= 1", ">= 1"),
                    ("not_more_rows", "silver", "s - b", "s <= b", "<= bronze"),
                    ("not_more_rows", "device_summary", "d - s", "d <= s", "<= silver"),
                ]
            ),
            measured(
                b="select count(*) from bronze",
                s="select count(*) from silver",
                d="select count(*) from device_summary",
                f="select count(*) from ml_features",
            ),
        ),
        "check_duplicates": gold(
            verdicts(
                [
                    ("unique(device_id,timestamp)", "bronze", "b", "b = 0", "= 0"),
                    ("unique(device_id,timestamp)", "silver", "s", "s = 0", "= 0"),
                    ("unique(device_id,window_start)", "device_health", "h", "h = 0", "= 0"),
                ]
            ),
            measured(
                b=REPEATED.format("bronze", "timestamp"),
                s=REPEATED.format("silver", "timestamp"),
                h=REPEATED.format("device_health", "window_start"),
            ),
        ),
        "check_nulls": gold(
            verdicts(
                [
                    (f"no_nulls({c})", t, f"{t}_{c}", f"{t}_{c} = 0", "= 0")
                    for t, columns in NULL_CHECKED.items()
                    for c in columns
                ]
            ),
            measured(
                **{
                    f"{t}_{c}": f"select {cnt(f'{c} is null')} from {t}"
                    for t, columns in NULL_CHECKED.items()
                    for c in columns
                }
            ),
        ),
        "check_ranges": gold(
            verdicts(
                [
                    ("in_range(humidity)", "silver", "hum", "hum = 0", "0.0..100.0"),
                    ("in_range(_quality_score)", "silver", "q", "q = 0", "0.0..1.0"),
                    ("in_range(pressure)", "silver", "p", "p = 0", "900.0..1100.0"),
                    ("in_range(health_score)", "device_health", "h", "h = 0", "0.0..1.0"),
                    (
                        "in_set(risk_tier)",
                        "device_health",
                        "t",
                        "t = 0",
                        "healthy,warning,critical",
                    ),
                ]
            ),
            measured(
                hum=f"select {cnt('humidity not between 0 and 100')} from silver",
                q=f"select {cnt('_quality_score not between 0 and 1')} from silver",
                p=f"select {cnt('pressure not between 900 and 1100')} from silver",
                h=f"select {cnt('health_score not between 0 and 1')} from device_health",
                t="select "
                + cnt("risk_tier not in ('healthy', 'warning', 'critical')")
                + " from device_health",
            ),
        ),
        "check_schema": silver(
            verdicts(
                [
                    (f"has_column({c})", "silver", f"s{i}", f"s{i} is not null", "present")
                    for i, c in enumerate(SILVER_COLUMNS)
                ]
                + [
                    (f"lacks_column({c})", "silver", "nothing", "nothing is null", "absent")
                    for c in ("_corrupt_record", "_source_file")
                ]
                + [("lacks_column(_corrupt_record)", "bronze", "bc", "bc is null", "absent")]
            ),
            measured(
                **{f"s{i}": f"select count({c}) from silver" for i, c in enumerate(SILVER_COLUMNS)},
                nothing="cast(null as bigint)",
                bc="select count(_corrupt_record) from bronze",
            ),
        ),
        "check_reconcile": gold(
            verdicts(
                [
                    (
                        "reconciles(event_count)",
                        "device_summary",
                        "e - s",
                        "e = s",
                        "= rows of silver",
                    ),
                    (
                        "covers(device_id)",
                        "device_summary",
                        "d - sd",
                        "d = sd",
                        "= distinct in silver",
                    ),
                    (
                        "covers(device_id)",
                        "ml_features",
                        "f - sd",
                        "f = sd",
                        "= distinct in silver",
                    ),
                ]
            ),
            measured(
                e="select sum(event_count) from device_summary",
                s="select count(*) from silver",
                d="select count(distinct device_id) from device_summary",
                f="select count(distinct device_id) from ml_features",
                sd="select count(distinct device_id) from silver",
            ),
        ),
        "check_distribution": gold(
            verdicts(
                [
                    (
                        "rate_between(_is_anomaly)",
                        "silver",
                        "r",
                        "r between 0 and 0.15",
                        "0.0..0.15",
                    ),
                    ("spread(health_score)", "device_health", "sp", "sp > 0.01", "> 0.01"),
                    ("distinct(health_score)", "device_health", "hs", "hs > 1", "> 1"),
                    ("distinct(device_id)", "device_health", "hd", "hd > 1", "> 1"),
                ]
            ),
            measured(
                r=f"select cast({cnt('_is_anomaly')} as double) / count(*) from silver",
                sp="select max(health_score) - min(health_score) from device_health",
                hs="select count(distinct health_score) from device_health",
                hd="select count(distinct device_id) from device_health",
            ),
        ),
        "ml_label": gold(
            f"select cast(anomaly_rate > 0 as int) as {MODEL_LABEL}, count(*) as n, "
            "cast(count(*) as double) / sum(count(*)) over () as share "
            "from ml_features group by 1"
        ),
        "ml_split": gold(
            f"select side, {MODEL_LABEL}, count(*) as n from labelled group by all", LABELLED
        ),
        "ml_weights": gold(
            f"select {MODEL_LABEL}, sum(count(*)) over () / (2.0::double * count(*)) as weight "
            f"from labelled group by {MODEL_LABEL}", LABELLED,
        ),
        "ml_columns": gold(" union all ".join(
            f"select '{f}' as feature, '{_category(f)}' as category, count({f}) as filled, "
            f"coalesce(max({f}) > min({f}), false) as varies from ml_features"
            for f in FEATURES if f not in LEAKING
        )),
        "rule_report": gold(" union all ".join(
            f"select '{name}' as class, {_over('hit', 'hit + false_hit')} as precision, "
            f"{_over('hit', 'hit + missed')} as recall, "
            f"{_over('2.0::double * hit / nullif(hit + false_hit, 0) * (hit::double / nullif(hit + missed, 0))', '(hit::double / nullif(hit + false_hit, 0) + hit::double / nullif(hit + missed, 0))')} as f1, "
            "hit + missed as support from ("
            f"select count(*) filter (where {MODEL_LABEL} = {c} and predicted_anomalous = {c}) as hit, "
            f"count(*) filter (where {MODEL_LABEL} <> {c} and predicted_anomalous = {c}) as false_hit, "
            f"count(*) filter (where {MODEL_LABEL} = {c} and predicted_anomalous <> {c}) as missed from scored)"
            for c, name in ((0, "Clean"), (1, "Anomalous"))
        ), LABELLED, RULE_SCORED),
        "rule_confusion": gold(
            f"select {MODEL_LABEL} as actual, count(*) filter (where predicted_anomalous = 0) as predicted_clean, "
            "count(*) filter (where predicted_anomalous = 1) as predicted_anomalous from scored group by 1",
            LABELLED, RULE_SCORED,
        ),
        "rule_roc": gold("select * from roc", LABELLED, RULE_SCORED, ROC),
        "rule_auc": gold(
            "select round(sum(fpr_step * (tpr - tpr_step / 2)), 9) as auc from roc", LABELLED, RULE_SCORED, ROC
        ),
        "rule_alerts": gold(
            "select device_id, window_start, window_end, predicted_prob, predicted_anomalous from scored "
            "where predicted_prob > 0.15", LABELLED, RULE_SCORED,
        ),
        "rule_drift": gold(
            "select *, round(predicted_rate - actual_rate, 9) as gap from ("
            "select date_trunc('day', window_start)::timestamp as period, count(*) as windows, "
            f"avg(predicted_anomalous) as predicted_rate, avg({MODEL_LABEL}) as actual_rate from scored group by 1)",
            LABELLED, RULE_SCORED,
        ),
        "bronze_stream": bronze(f"select {AS_PARSED} from bronze"),
        "stream_restart": bronze(
            "select case when _corrupt_record is null then location end as location, "
            "count(*) as n from bronze group by 1"
        ),
        "schema_drift": bronze(
            f"select {RAW}, cast(null as varchar) as _corrupt_record from bronze "
            "where _corrupt_record is null"
        ),
        "silver_stream": silver(f"select {SILVER_NO_CLOCK} from silver"),
        "stream_dedup": silver("select device_id, timestamp, 1::bigint as copies from silver"),
        "late_data": silver(
            "select location, count(*) as n, min(timestamp) as oldest, "
            "(select count(*) from usable where timestamp <= (select edge from cut)) as late_rows "
            "from silver where timestamp > (select edge from cut) group by location",
            LATE,
        ),
        "gold_stream": gold(
            "select * from device_summary where window_end <= "
            "(select date_trunc('milliseconds', max(timestamp)) - to_seconds(cast(floor("
            "date_diff('microseconds', min(timestamp), max(timestamp)) / 2e6) as bigint) + 2) from silver)"
        ),
        "stream_metrics": bronze(
            "select 'bronze' as layer, count(*) as records_processed, 0::bigint as errors, "
            "0::bigint as late_rows from bronze union all "
            "select 'silver', count(*), 0, 0 from bronze"
        ),
        "gold_build": gold(
            " union all ".join(
                f"select '{t}' as table_name, count(*) as row_count, count(*) as stamped_rows, "
                f"count(distinct device_id) as devices from {t}"
                for t in ("device_summary", "anomaly_summary", "device_health", "ml_features")
            )
        ),
        "prefix_slice": silver(
            f"select device_id, count(*) as n, {cnt('_is_anomaly')} as anomalies from silver "
            "where starts_with(device_id, 'device-00') group by device_id"
        ),
        "empty_or_stored": bronze("select 'after' as time, location, count(*) as n from bronze group by location"),
        "check_storage": bronze(
            "select c || ' exist' as \"check\", 'bronze' as layer, case when n > 0 then 'pass' else 'fail' end "
            "as status, e as expected from (select count(*) as n from bronze), "
            "(values ('files', '> 0'), ('offsets', '> 0'), ('commits', '= offsets')) as t(c, e)"
        ),
        "maintain": gold(
            "select layer, action, case when action = 'expire' then "
            "case when layer like 'Gold%' then 'kept forever' else 'expired' end end as status, rows_left "
            "from (select 'Bronze' as layer, count(*) as rows_left from bronze "
            "union all select 'Silver', count(*) from silver "
            + "".join(
                f"union all select 'Gold/{t}', count(*) from {t} "
                for t in ("device_summary", "anomaly_summary", "device_health", "ml_features")
            )
            + "), (values ('compact'), ('expire')) as a(action)"
        ),
        "time_travel": bronze(
            "select *, row_count - first_value(row_count) over (order by version) "
            "as added_since_first from (select 0::bigint as version, "
            f"{cnt("location = 'click'")} as row_count from bronze union all "
            f"select 1, {cnt("location in ('click', 'view')")} from bronze union all "
            "select 2, count(*) from bronze)"
        ),
        "table_history": silver(
            f"""select 'bronze' as "table", 0::bigint as version, 'APPEND' as operation,
              {cnt("location = 'click'")} as row_count from bronze
            union all select 'bronze', 1, 'APPEND', {cnt("location = 'view'")} from bronze
            union all select 'bronze', 2, 'APPEND', {cnt("location not in ('click', 'view')")}
              from bronze
            union all select 'silver', 0, 'OVERWRITE', count(*) from silver"""
        ),
        "schema_evolution": bronze(
            "select device_id, timestamp, temperature, "
            "case when location <> 'click' then battery_level end as battery_level from bronze"
        ),
        "compact": bronze(
            "select location, count(*) as n, true as fewer_files from bronze group by location"
        ),
        "expire": bronze("select location, count(*) as n from bronze group by location"),
    }


RATES = f"""
rates as (
  select *, cast(anomaly_count as double) / nullif(total_events, 0) as anomaly_rate from (
    select device_id, count(_is_anomaly) as total_events, {cnt('_is_anomaly')} as anomaly_count
    from silver group by device_id))
"""
DEVICE_Z = (
    "select device_id, "
    + ", ".join(
        f"{mean(f'abs(_{c}_zscore)', 2)} as avg_abs_{c}_z" for c, *_ in SENSORS
    )
    + " from silver group by device_id"
)
NULL_CHECKED = {
    "silver": ("device_id", "timestamp", "humidity", "_quality_score", "_is_anomaly"),
    "device_summary": ("device_id", "window_start", "event_count", "avg_quality_score"),
    "ml_features": ("device_id", "temp_mean", "battery_mean", "quality_mean", "quality_min"),
}
