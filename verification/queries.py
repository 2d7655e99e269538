"""The registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each one runs a library operator over the telemetry view of the whole ``events``
table. Streaming and table queries write what they need to a fresh working folder
first and return a frame over the result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telestrata.operators import checks, cleaning, distributions, enrich, health
from telestrata.operators import lineage, model, profiles, windows
from telestrata.plans.gold import build_and_write, read_gold
from telestrata.plans.maintenance import run_maintenance, snapshot_streamed_layer
from telestrata.plans.silver import apply_transformations
from telestrata.schema import TELEMETRY_COLUMNS
from telestrata.settings import TIERS, Settings
from telestrata.sources import snapshots
from telestrata.sources.events import (
    bronze_from_events,
    landing_lines,
    read_events,
    replayed_stamp,
)
from telestrata.sources.landing import parse_lines
from telestrata.sources.layers import read_layer, read_or_empty
from telestrata.sources.storage import data_files, workspace
from telestrata.streaming.jobs import start_bronze, start_gold, start_silver
from telestrata.streaming.metrics import layer_metrics, totals_frame
from telestrata.streaming.sinks import drained
from telestrata.streaming.storage import check_stream_storage

# Every stream query keeps to one rule: no new row of a wave lies more than the watermark
# delay behind any row of the same or an earlier wave. Then no result depends on the number
# of batches, and any admission limit will do.
STREAM = Settings()


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_from_events(read_events(spark, sf))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return apply_transformations(bronze(spark, sf), processed_at=replayed_stamp())


def telemetry(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(spark, sf).select(*TELEMETRY_COLUMNS)


def summary(spark, sf):
    return windows.compute_device_summary(silver(spark, sf))


def anomalies(spark, sf):
    return windows.compute_anomaly_summary(silver(spark, sf))


def device_health(spark, sf):
    return windows.compute_device_health(silver(spark, sf))


def features(spark, sf):
    return windows.compute_ml_features(silver(spark, sf))


def gold_tables(spark, sf) -> dict[str, DataFrame]:
    """The four tables over one wide aggregate, which is written once and read per table."""
    path = workspace(spark, "window-stats")
    aggregate = windows.window_stats(silver(spark, sf))
    aggregate.write.parquet(path)
    stats = spark.read.schema(aggregate.schema).parquet(path)
    return {
        name: project(stats, Settings()) for name, project in windows.GOLD_TABLES.items()
    }


def once(spark, sf, texts: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Silver, written once with those of its texts that are asked for, and the four tables over it.

    Scan and deduplication run once per query; what follows reads only its own columns.
    """
    path = workspace(spark, "silver-once")
    left_out = {"location", "firmware_version", "_anomaly_details"} - set(texts)
    rows = silver(spark, sf).drop(*left_out)
    rows.write.parquet(path)
    staged = spark.read.schema(rows.schema).parquet(path)
    return staged, over(staged)


def over(rows: DataFrame) -> dict[str, DataFrame]:
    """The four tables as projections; each aggregates only what is read of it."""
    stats = windows.window_stats(rows)
    return {name: project(stats, Settings()) for name, project in windows.GOLD_TABLES.items()}


def without_zone(df: DataFrame) -> DataFrame:
    """Event times as the zone-less type that the test tables use."""
    stamps = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


def rounded(df: DataFrame, columns: list[str], places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# Cleaning and derivations


def parse_telemetry(spark, sf):
    return without_zone(parse_lines(landing_lines(bronze(spark, sf))))


def corrupt_capture(spark, sf):
    return parse_telemetry(spark, sf).where("_corrupt_record is not null").select(
        "_corrupt_record"
    )


def normalize(spark, sf):
    raw = telemetry(spark, sf)
    kept = F.when(F.col("raw_humidity").isNotNull(), F.col("humidity"))
    both = enrich.normalize_units(raw.withColumn("raw_humidity", F.col("humidity")))
    return both.select("device_id", "timestamp", "humidity", kept.alias("humidity_null_safe"))


def zscores(spark, sf):
    scored = enrich.add_zscores(telemetry(spark, sf))
    return scored.select(
        "device_id", "timestamp", *[s.zscore for s in Settings().sensors]
    )


def quality_score(spark, sf):
    tagged = enrich.tag_anomalies(telemetry(spark, sf))
    return enrich.add_quality_score(tagged).select(
        "device_id", "timestamp", "_is_anomaly", "_quality_score"
    )


def anomaly_slice(spark, sf):
    rows = silver(spark, sf)
    shown = ("device_id", "timestamp", "_anomaly_details", "_quality_score")
    parts = [
        part.select(F.lit(name).alias("slice"), *shown)
        for name, part in (
            ("anomalous", enrich.only_anomalies(rows)),
            ("clean", enrich.only_clean(rows)),
        )
    ]
    return parts[0].unionByName(parts[1])


def prefix_slice(spark, sf):
    rows = enrich.with_prefix(silver(spark, sf), "device-00")
    return rows.groupBy("device_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_is_anomaly").alias("anomalies")
    )


def latency(spark, sf):
    return enrich.processing_latency(silver(spark, sf))


# Profiles


def numeric_ranges(spark, sf):
    ranges = profiles.numeric_ranges(bronze(spark, sf))
    return rounded(ranges, [c for c in ranges.columns if c.endswith("_avg")])


def layer_funnel(spark, sf):
    # Row counts need keys only, so all layers after Bronze share one deduplication.
    rows = silver(spark, sf)
    return profiles.layer_funnel({"bronze": bronze(spark, sf), "silver": rows, **over(rows)})


def dq_summary(spark, sf):
    rows, gold = once(spark, sf)
    return profiles.dq_summary(bronze(spark, sf), rows, gold)


def kpis(spark, sf):
    rows, gold = once(spark, sf)
    return health.kpis(gold["anomaly_summary"], gold["device_health"], enrich.processing_latency(rows))


def features_health(spark, sf):
    gold = gold_tables(spark, sf)
    return health.join_features_health(gold["ml_features"], gold["device_health"])


# Checks


def check_counts(spark, sf):
    rows = silver(spark, sf)
    tables = {"bronze": bronze(spark, sf), "silver": rows, **over(rows)}
    rules = [
        *[
            checks.row_count(t, at_least=1)
            for t in ("bronze", "silver", "device_summary", "ml_features")
        ],
        checks.not_more_rows("silver", than="bronze"),
        checks.not_more_rows("device_summary", than="silver"),
    ]
    return checks.run_checks(tables, rules)


def check_duplicates(spark, sf):
    tables = {
        "bronze": bronze(spark, sf),
        "silver": silver(spark, sf),
        "device_health": device_health(spark, sf),
    }
    rules = [
        checks.unique("bronze", ("device_id", "timestamp")),
        checks.unique("silver", ("device_id", "timestamp")),
        checks.unique("device_health", ("device_id", "window_start")),
    ]
    return checks.run_checks(tables, rules)


def check_nulls(spark, sf):
    rows, gold = once(spark, sf)
    tables = {"silver": rows, **gold}
    columns = {
        "silver": ("device_id", "timestamp", "humidity", "_quality_score", "_is_anomaly"),
        "device_summary": ("device_id", "window_start", "event_count", "avg_quality_score"),
        "ml_features": ("device_id", "temp_mean", "battery_mean", "quality_mean", "quality_min"),
    }
    rules = [r for t, names in columns.items() for r in checks.no_nulls(t, names)]
    return checks.run_checks(tables, rules)


def check_ranges(spark, sf):
    tables = {"silver": silver(spark, sf), "device_health": device_health(spark, sf)}
    rules = [
        checks.in_range("silver", "humidity", 0.0, 100.0),
        checks.in_range("silver", "_quality_score", 0.0, 1.0),
        checks.in_range("silver", "pressure", 900.0, 1100.0),
        checks.in_range("device_health", "health_score", 0.0, 1.0),
        checks.in_set("device_health", "risk_tier", TIERS),
    ]
    return checks.run_checks(tables, rules)


def check_schema(spark, sf):
    raw, clean = bronze(spark, sf), silver(spark, sf)
    rules = [
        *checks.has_columns("silver", clean, clean.columns),
        *checks.lacks_columns("silver", clean, ("_corrupt_record", "_source_file")),
        *checks.lacks_columns("bronze", raw, ("_corrupt_record",)),
    ]
    return checks.run_checks({"bronze": raw, "silver": clean}, rules)


def check_reconcile(spark, sf):
    rows, gold = once(spark, sf)
    tables = {"silver": rows, **gold}
    rules = [
        checks.reconciles("device_summary", "event_count", with_rows_of="silver"),
        checks.covers("device_summary", "device_id", of="silver"),
        checks.covers("ml_features", "device_id", of="silver"),
    ]
    return checks.run_checks(tables, rules)


def check_distribution(spark, sf):
    tables = {"silver": silver(spark, sf), "device_health": device_health(spark, sf)}
    rules = [
        checks.rate_between("silver", "_is_anomaly", 0.0, 0.15),
        checks.spread_over("device_health", "health_score", 0.01),
        checks.distinct_over("device_health", "health_score", 1),
        checks.distinct_over("device_health", "device_id", 1),
    ]
    return checks.run_checks(tables, rules)


# Streams


class Folders:
    """Fresh folders of one streaming run."""

    def __init__(self, spark: SparkSession, name: str):
        root = workspace(spark, name)
        self.landing, self.bronze, self.silver, self.gold = (
            f"{root}/{part}" for part in ("landing", "bronze", "silver", "gold")
        )
        self.state = f"{root}/checkpoints"


def arrive(rows: DataFrame, at: Folders) -> None:
    """Put rows into the landing folder as JSON lines."""
    landing_lines(rows).write.mode("append").text(at.landing)


def to_bronze(spark, at: Folders):
    return drained(start_bronze(spark, at.landing, at.bronze, f"{at.state}/bronze", STREAM, True))


def to_silver(spark, at: Folders, hours: float = STREAM.dedup_window_hours):
    config = replace(STREAM, dedup_window_hours=hours)
    return drained(start_silver(spark, at.bronze, at.silver, f"{at.state}/silver", config, True))


def hours_of(rows: DataFrame, share: float = 1.0) -> float:
    """A little more than a share of the time between the first and the last row."""
    low, high = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    return (int((high - low).total_seconds() * share) + 2) / 3600


def middle_of(rows: DataFrame) -> datetime:
    low, high = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    return low + (high - low) / 2


def bronze_stream(spark, sf):
    at = Folders(spark, "bronze-stream")
    arrive(bronze(spark, sf), at)
    to_bronze(spark, at)
    return without_zone(read_layer(spark, at.bronze)).drop("_ingested_at", "_source_file")


def ingest_metadata(spark, sf):
    at = Folders(spark, "ingest-metadata")
    arrive(bronze(spark, sf), at)
    to_bronze(spark, at)
    return read_layer(spark, at.bronze).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("_ingested_at").alias("stamped_rows"),
        F.count_if(F.col("_source_file").contains("landing")).alias("rows_with_file"),
    )


def stream_restart(spark, sf):
    """Two waves and an idle run on one checkpoint; every row exactly once."""
    at = Folders(spark, "stream-restart")
    rows = bronze(spark, sf)
    cut = F.lit(middle_of(rows))
    arrive(rows.where(F.col("timestamp") < cut), at)
    to_bronze(spark, at)
    arrive(rows.where(F.col("timestamp") >= cut), at)
    to_bronze(spark, at)
    to_bronze(spark, at)
    return read_layer(spark, at.bronze).groupBy("location").agg(
        F.count(F.lit(1)).alias("n")
    )


def schema_drift(spark, sf):
    """Devices that send fields the schema does not know."""
    at = Folders(spark, "schema-drift")
    known = bronze(spark, sf).where(F.col("_corrupt_record").isNull())
    drifted = F.struct(
        *TELEMETRY_COLUMNS,
        (F.col("pressure") * 2).alias("rack"),
        F.lit("north").alias("carrier"),
    )
    fmt = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    known.select(F.to_json(drifted, fmt).alias("value")).write.text(at.landing)
    to_bronze(spark, at)
    return without_zone(read_layer(spark, at.bronze)).drop("_ingested_at", "_source_file")


def silver_stream(spark, sf):
    """Two waves in order of time; the second resends all of the first."""
    at = Folders(spark, "silver-stream")
    rows = bronze(spark, sf)
    cut, hours = F.lit(middle_of(rows)), hours_of(rows, 0.5)
    arrive(rows.where(F.col("timestamp") < cut), at)
    to_bronze(spark, at)
    to_silver(spark, at, hours)
    arrive(rows, at)
    to_bronze(spark, at)
    to_silver(spark, at, hours)
    cleaned = without_zone(read_layer(spark, at.silver))
    return cleaned.drop("_ingested_at", "_processed_at")


def stream_dedup(spark, sf):
    """Everything is sent twice; each key is kept once."""
    at = Folders(spark, "stream-dedup")
    rows = bronze(spark, sf)
    hours = hours_of(rows)
    for _ in range(2):
        arrive(rows, at)
        to_bronze(spark, at)
        to_silver(spark, at, hours)
    kept = without_zone(read_layer(spark, at.silver))
    return kept.groupBy("device_id", "timestamp").agg(F.count(F.lit(1)).alias("copies"))


def late_data(spark, sf):
    """The newest 24 hours arrive first, so all older rows are late."""
    at = Folders(spark, "late-data")
    rows = bronze(spark, sf)
    usable = F.col("_corrupt_record").isNull() & F.col("device_id").isNotNull()
    newest = rows.where(usable).agg(F.date_trunc("millisecond", F.max("timestamp"))).first()[0]
    cut = F.lit(newest - timedelta(hours=STREAM.dedup_window_hours))
    new = F.coalesce(usable & (F.col("timestamp") > cut), F.lit(False))
    late = 0
    for wave in (new, ~new):
        arrive(rows.where(wave), at)
        to_bronze(spark, at)
        late += to_silver(spark, at).late
    return (
        without_zone(read_layer(spark, at.silver))
        .groupBy("location")
        .agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("oldest"))
        .withColumn("late_rows", F.lit(late).cast("long"))
    )


def gold_stream(spark, sf):
    """Two halves in order of time; windows that end half the period before the last row."""
    at = Folders(spark, "gold-stream")
    rows = silver(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    cut = F.lit(middle_of(rows))
    config = replace(STREAM, dedup_window_hours=hours_of(rows, 0.5))
    for half in (F.col("timestamp") < cut, F.col("timestamp") >= cut):
        rows.where(half).write.mode("append").parquet(at.silver)
        drained(start_gold(spark, at.silver, at.gold, f"{at.state}/gold", config, True))
    return without_zone(spark.read.parquet(at.gold))


def stream_metrics(spark, sf):
    at = Folders(spark, "stream-metrics")
    rows = bronze(spark, sf)
    arrive(rows, at)
    runs = {"bronze": to_bronze(spark, at), "silver": to_silver(spark, at, hours_of(rows))}
    measured = layer_metrics(totals_frame(spark, runs))
    return measured.select("layer", "records_processed", "errors", "late_rows")


def check_storage(spark, sf):
    at = Folders(spark, "check-storage")
    arrive(bronze(spark, sf), at)
    to_bronze(spark, at)
    found = check_stream_storage(spark, "bronze", at.bronze, f"{at.state}/bronze")
    return found.drop("observed")  # numbers of files and batches depend on the cores


# Stored tables


def three_appends(spark, sf) -> str:
    path = workspace(spark, "bronze-table")
    place = F.col("location")
    for wave in (place == "click", place == "view", ~place.isin("click", "view")):
        snapshots.commit(bronze(spark, sf).where(wave), path, "append")
    return path


def gold_build(spark, sf):
    root = workspace(spark, "gold")
    names = list(build_and_write(silver(spark, sf), root))
    counts = None
    for name in names:
        one = read_gold(spark, root, name).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count("_aggregated_at").alias("stamped_rows"),
            F.count_distinct("device_id").alias("devices"),
        ).select(F.lit(name).alias("table_name"), "row_count", "stamped_rows", "devices")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def empty_or_stored(spark, sf):
    """A layer before and after it was first written."""
    rows, path = bronze(spark, sf), workspace(spark, "not-yet")
    before = read_or_empty(spark, path, rows.schema)
    counts = [before.select(F.lit("before").alias("time"), "location")]
    rows.write.parquet(path)
    after = read_or_empty(spark, path, rows.schema)
    counts.append(after.select(F.lit("after").alias("time"), "location"))
    return counts[0].unionByName(counts[1]).groupBy("time", "location").agg(F.count(F.lit(1)).alias("n"))


def time_travel(spark, sf):
    return snapshots.rows_by_version(spark, three_appends(spark, sf))


def table_history(spark, sf):
    tables = {"bronze": three_appends(spark, sf), "silver": workspace(spark, "silver-table")}
    snapshots.commit(silver(spark, sf), tables["silver"])
    return snapshots.merged_history(spark, tables).select(
        "table", "version", "operation", "row_count"
    )


def schema_evolution(spark, sf):
    """The first write lacks a column that the second one brings."""
    path = workspace(spark, "evolving-table")
    shown = ["device_id", "timestamp", "temperature"]
    first = F.col("location") == "click"
    snapshots.commit(bronze(spark, sf).where(first).select(*shown), path, "append")
    snapshots.commit(
        bronze(spark, sf).where(~first).select(*shown, "battery_level"), path, "append"
    )
    return snapshots.read_version(spark, path)


def compact(spark, sf):
    path = three_appends(spark, sf)
    before = snapshots.read_version(spark, path).inputFiles()
    done = snapshots.compact(spark, path)
    fewer = done is not None and done.num_files < len(before)
    return (
        snapshots.read_version(spark, path)
        .groupBy("location")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("fewer_files", F.lit(fewer))
    )


def expire(spark, sf):
    """Compaction replaces three versions; a later sweep removes them."""
    path = three_appends(spark, sf)
    snapshots.compact(spark, path)
    later = datetime.now(timezone.utc) + timedelta(hours=2)
    snapshots.expire(spark, path, retention_hours=1, now=later)
    return (
        snapshots.read_version(spark, path)
        .groupBy("location")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def maintain(spark, sf):
    settings = Settings(optimize_enabled=True, vacuum_enabled=True)
    at = Folders(spark, "maintain")
    raw, clean, root = f"{at.bronze}-table", f"{at.silver}-table", at.gold
    rows = bronze(spark, sf)
    arrive(rows, at)
    to_bronze(spark, at)
    to_silver(spark, at, hours_of(rows))
    snapshot_streamed_layer(spark, at.bronze, raw)
    snapshot_streamed_layer(spark, at.silver, clean)
    build_and_write(snapshots.read_version(spark, clean), root, settings)
    done = run_maintenance(spark, raw, clean, root, settings)
    left = {"Bronze": snapshots.read_version(spark, raw), "Silver": snapshots.read_version(spark, clean)}
    left |= {f"Gold/{name}": read_gold(spark, root, name) for name in windows.GOLD_TABLES}
    sizes = None
    for layer, rows in left.items():
        one = rows.agg(F.count(F.lit(1)).alias("rows_left")).withColumn("layer", F.lit(layer))
        sizes = one if sizes is None else sizes.unionByName(one)
    # Whether there was something to compact depends on the cores that wrote the files.
    kept = F.when(F.col("action") == "expire", F.col("status"))
    return done.join(sizes, "layer").select("layer", "action", kept.alias("status"), "rows_left")


# Model. One fitted model serves all model queries of a session and scale.

_MODELS: dict[tuple[str, str, str], tuple] = {}


def trained(spark, sf):
    """Labelled features (written once, so no pass recomputes them) and the model."""
    files = data_files(spark, f"{sf}/events.parquet").orderBy("path").collect()
    key = (spark.sparkContext.applicationId, sf, str(files))
    if key not in _MODELS:
        path = workspace(spark, "labelled-features")
        model.split(model.add_label(features(spark, sf))).write.parquet(path)
        labelled = spark.read.parquet(path)
        training = labelled.where(F.col("side") == "train").drop("side")
        _MODELS[key] = (labelled, model.train(training))
    return _MODELS[key]


def scored_test(spark, sf):
    labelled, fitted = trained(spark, sf)
    return model.score(fitted, labelled.where(F.col("side") == "test").drop("side"))


def ml_split(spark, sf):
    labelled = model.split(model.add_label(features(spark, sf)))
    return labelled.groupBy("side", model.LABEL).agg(F.count(F.lit(1)).alias("n"))


def rule_scored(spark, sf):
    """The test windows under a fixed score with ties, so that every figure can be checked."""
    labelled = model.split(model.add_label(features(spark, sf))).where("side = 'test'")
    score = F.least(F.lit(1.0), F.coalesce("temp_zscore_abs_max", F.lit(0.0)) / 20.0)
    scored = labelled.drop("side").withColumn("predicted_prob", score)
    return scored.withColumn("predicted_anomalous", (F.col("predicted_prob") > 0.1).cast("int"))


def rule_auc(spark, sf):
    return rounded(model.auc(model.roc_points(rule_scored(spark, sf))), ["auc"], 9)


def rule_drift(spark, sf):
    return rounded(without_zone(model.drift(rule_scored(spark, sf))), ["gap"], 9)


def ml_weights(spark, sf):
    labelled = model.add_label(features(spark, sf))
    weighted = model.add_class_weights(labelled)
    return weighted.groupBy(model.LABEL).agg(F.max("weight").alias("weight"))


def ml_columns(spark, sf):
    """The features that the model may see: category, filled windows, and whether they vary."""
    table = features(spark, sf)
    found = distributions.describe_features(table, model.model_features(table))
    return found.select(
        "feature",
        model.category(F.col("feature")).alias("category"),
        F.col("count").alias("filled"),
        F.coalesce(F.col("max") > F.col("min"), F.lit(False)).alias("varies"),
    )


def ml_train(spark, sf):
    labelled, fitted = trained(spark, sf)
    scored = model.score(fitted, labelled.where(F.col("side") == "train").drop("side"))
    return scored.groupBy(model.LABEL).agg(
        F.count(F.lit(1)).alias("n"), F.avg("predicted_prob").alias("mean_prob")
    )


def ml_roc(spark, sf):
    path = workspace(spark, "scored-test")
    # The points read their input several times; the forest scores it once.
    scored = scored_test(spark, sf).select(model.LABEL, "predicted_prob")
    scored.write.parquet(path)
    points = model.roc_points(spark.read.schema(scored.schema).parquet(path))
    area = model.auc(points).select(F.lit("auc").alias("figure"), F.col("auc").alias("value"))
    size = points.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("points").alias("figure"), "value"
    )
    return area.unionByName(size)


def ml_importance(spark, sf):
    return model.top_importance(model.feature_importance(spark, trained(spark, sf)[1]))


def ml_importance_by_category(spark, sf):
    return model.importance_by_category(
        model.feature_importance(spark, trained(spark, sf)[1])
    )


def ml_score(spark, sf):
    """Every window as it is, and as if it had run hot."""
    labelled, fitted = trained(spark, sf)
    shown = ("device_id", "window_start", "predicted_prob", "predicted_anomalous")
    hot = {"temp_mean": 155.0, "temp_range": 130.0, "temp_zscore_abs_mean": 8.0}
    as_is = model.score(fitted, labelled.drop("side")).select(F.lit("as is").alias("case"), *shown)
    edited = model.what_if(fitted, labelled.drop("side"), hot)
    return as_is.unionByName(edited.select(F.lit("what if").alias("case"), *shown))


def ml_alerts(spark, sf):
    labelled, fitted = trained(spark, sf)
    return model.alerts(model.score(fitted, labelled.drop("side")))


def ml_drift(spark, sf):
    labelled, fitted = trained(spark, sf)
    return model.drift(model.score(fitted, labelled.drop("side")))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "parse_telemetry": parse_telemetry,
        "corrupt_capture": corrupt_capture,
        "ingest_metadata": ingest_metadata,
        "drop_corrupt": lambda s, d: cleaning.drop_corrupt_records(bronze(s, d)),
        "drop_nulls": lambda s, d: cleaning.drop_nulls(bronze(s, d)),
        "dedup": lambda s, d: cleaning.deduplicate(bronze(s, d)),
        "dedup_first": lambda s, d: cleaning.deduplicate_first(bronze(s, d)),
        "normalize": normalize,
        "tag_anomalies": lambda s, d: enrich.tag_anomalies(telemetry(s, d)),
        "zscores": zscores,
        "quality_score": quality_score,
        "silver": silver,
        "anomaly_slice": anomaly_slice,
        "prefix_slice": prefix_slice,
        "latency": latency,
        "device_summary": summary,
        "device_summary_30m": lambda s, d: windows.compute_device_summary(
            silver(s, d), "30 minutes"
        ),
        "device_summary_2h": lambda s, d: windows.compute_device_summary(
            silver(s, d), "2 hours"
        ),
        "anomaly_summary": anomalies,
        "device_health": device_health,
        "ml_features": features,
        "bronze_profile": lambda s, d: profiles.bronze_profile(bronze(s, d)),
        "numeric_ranges": numeric_ranges,
        "silver_profile": lambda s, d: profiles.silver_profile(silver(s, d)),
        "anomaly_breakdown": lambda s, d: profiles.anomaly_breakdown(silver(s, d)),
        "layer_funnel": layer_funnel,
        "dq_summary": dq_summary,
        "schema_diff": lambda s, d: lineage.schema_diff(bronze(s, d), silver(s, d)),
        "device_anomaly_rate": lambda s, d: profiles.device_anomaly_rate(silver(s, d)),
        "anomaly_by_device": lambda s, d: profiles.anomaly_by_device(anomalies(s, d)),
        "device_abs_z": lambda s, d: profiles.device_abs_z(silver(s, d)),
        "z_rule_agreement": lambda s, d: profiles.z_rule_agreement(silver(s, d)),
        "anomaly_per_minute": lambda s, d: profiles.anomaly_per_minute(silver(s, d)),
        "battery_split": lambda s, d: profiles.battery_split(silver(s, d)),
        "hist_sensor": lambda s, d: distributions.sensor_histogram(silver(s, d)),
        "hist_zscore": lambda s, d: distributions.zscore_histogram(silver(s, d)),
        "hist_quality": lambda s, d: distributions.quality_histogram(silver(s, d)),
        "hist_health": lambda s, d: distributions.health_histogram(device_health(s, d)),
        "hist_latency": lambda s, d: distributions.latency_histogram(latency(s, d)),
        "hist_features": lambda s, d: distributions.feature_histogram(features(s, d)),
        "risk_tiers": lambda s, d: health.risk_tiers(device_health(s, d)),
        "device_rollup": lambda s, d: health.ranked_devices(
            health.device_rollup(device_health(s, d))
        ),
        "health_stats": lambda s, d: health.health_stats(device_health(s, d)),
        "kpis": kpis,
        "health_decomposition": lambda s, d: health.health_decomposition(
            health.device_rollup(device_health(s, d))
        ),
        "feature_describe": lambda s, d: distributions.describe_features(
            features(s, d), places=6
        ),
        "feature_corr": lambda s, d: distributions.feature_correlation(
            features(s, d), places=6
        ),
        "top_devices": lambda s, d: health.top_windows(summary(s, d)),
        "top_anomaly_rate": lambda s, d: health.top_anomaly_rate(
            profiles.device_anomaly_rate(silver(s, d))
        ),
        "top_abs_z": lambda s, d: health.top_abs_z(profiles.device_abs_z(silver(s, d))),
        "lowest_health": lambda s, d: health.lowest_health(device_health(s, d)),
        "features_health": features_health,
        "health_trend": lambda s, d: health.health_trend(device_health(s, d)),
        "check_counts": check_counts,
        "check_duplicates": check_duplicates,
        "check_nulls": check_nulls,
        "check_ranges": check_ranges,
        "check_schema": check_schema,
        "check_reconcile": check_reconcile,
        "check_distribution": check_distribution,
        "check_storage": check_storage,
        "bronze_stream": bronze_stream,
        "stream_restart": stream_restart,
        "schema_drift": schema_drift,
        "silver_stream": silver_stream,
        "stream_dedup": stream_dedup,
        "late_data": late_data,
        "gold_stream": gold_stream,
        "stream_metrics": stream_metrics,
        "gold_build": gold_build,
        "empty_or_stored": empty_or_stored,
        "time_travel": time_travel,
        "table_history": table_history,
        "schema_evolution": schema_evolution,
        "compact": compact,
        "expire": expire,
        "maintain": maintain,
        "ml_label": lambda s, d: model.class_balance(model.add_label(features(s, d))),
        "ml_split": ml_split,
        "ml_train": ml_train,
        "ml_weights": ml_weights,
        "ml_columns": ml_columns,
        "rule_report": lambda s, d: model.classification_report(rule_scored(s, d)),
        "rule_confusion": lambda s, d: model.confusion_matrix(rule_scored(s, d)),
        "rule_roc": lambda s, d: model.roc_points(rule_scored(s, d)),
        "rule_auc": rule_auc,
        "rule_alerts": lambda s, d: without_zone(model.alerts(rule_scored(s, d), 0.15)),
        "rule_drift": rule_drift,
        "ml_report": lambda s, d: model.classification_report(scored_test(s, d)),
        "ml_confusion": lambda s, d: model.confusion_matrix(scored_test(s, d)),
        "ml_roc": ml_roc,
        "ml_importance": ml_importance,
        "ml_importance_by_category": ml_importance_by_category,
        "ml_score": ml_score,
        "ml_alerts": ml_alerts,
        "ml_drift": ml_drift,
    }
