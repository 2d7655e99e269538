"""Streams are run to the end in several starts over one checkpoint."""

import pytest
from pyspark.sql import functions as F

from telestrata.operators.windows import compute_device_summary
from telestrata.plans.silver import apply_transformations
from telestrata.settings import Settings
from telestrata.sources.layers import read_layer
from telestrata.streaming.jobs import start_bronze, start_gold, start_silver
from telestrata.streaming.metrics import StreamTotals, layer_metrics, totals_frame
from telestrata.streaming.sinks import drained
from telestrata.streaming.storage import check_stream_storage
from __spark_entry__ import oracle_sql, queries
from tests.conftest import event
from tests.test_entry import SMALL
from tests.vectors import edge_feed, plain_silver
from verification import queries as verified
from verify_queries import compare, connect


class Run:
    def __init__(self, spark, root, config=None):
        self.spark, self.config = spark, config or Settings(max_files_per_trigger=1000)
        self.landing, self.bronze, self.silver, self.gold, self.state = (
            str(root / n) for n in ("landing", "bronze", "silver", "gold", "state")
        )

    def to_bronze(self):
        return drained(
            start_bronze(self.spark, self.landing, self.bronze, f"{self.state}/b", self.config, True)
        )

    def to_silver(self, **options):
        return drained(
            start_silver(
                self.spark, self.bronze, self.silver, f"{self.state}/s", self.config, True, **options
            )
        )

    def to_gold(self):
        return drained(
            start_gold(self.spark, self.silver, self.gold, f"{self.state}/g", self.config, True)
        )

    def rows(self, layer):
        return read_layer(self.spark, getattr(self, layer))


@pytest.fixture()
def run(spark, tmp_path):
    return Run(spark, tmp_path)


def test_the_limits_through_the_streams(run, land):
    feed = edge_feed()
    land(*feed)
    run.to_bronze()
    run.to_silver()
    bronze, silver = run.rows("bronze"), run.rows("silver")
    assert bronze.count() == len(feed) and len(bronze.columns) == 11
    assert bronze.where("_corrupt_record is not null").count() == sum(isinstance(x, str) for x in feed)
    assert bronze.where("_ingested_at is null or _source_file is null").count() == 0
    assert silver.count() == len(plain_silver(feed)) and len(silver.columns) == 19
    as_batch = apply_transformations(bronze)
    clock = ("_ingested_at", "_processed_at")
    assert silver.drop(*clock).exceptAll(as_batch.drop(*clock)).count() == 0


def test_restart_takes_each_file_once(run, land):
    land(*[event(m) for m in range(60)], name="a.json")
    run.to_bronze()
    assert run.rows("bronze").count() == 60
    land(*[event(m, device_id="d2") for m in range(60)], name="b.json")
    run.to_bronze()
    run.to_bronze()
    assert run.rows("bronze").count() == 120
    found = check_stream_storage(run.spark, "bronze", run.bronze, f"{run.state}/b").collect()
    assert [r.status for r in found] == ["pass"] * 3


def test_admission_limit_makes_several_batches(spark, tmp_path, land):
    run = Run(spark, tmp_path, Settings(max_files_per_trigger=1))
    for i in range(3):
        land(event(i), name=f"{i}.json")
    totals = run.to_bronze()
    assert (totals.batches, totals.records) == (3, 3)


def report(batch, rows=1, **more):
    return {"batchId": batch, "numInputRows": rows, "timestamp": f"2024-11-05T10:00:{batch % 60:02d}.000Z",
            "stateOperators": [], "durationMs": {"addBatch": 1, "triggerExecution": 2}, **more}


def test_totals_hold_more_batches_than_reports_are_kept():
    totals = StreamTotals(None)
    for end in range(0, 500, 40):
        totals.take([report(b) for b in range(max(0, end - 99), end + 1)])
    assert (totals.batches, totals.records, totals.busy_ms) == (481, 481, 962)
    totals.take([report(481, 0, durationMs={"triggerExecution": 1})])
    assert totals.batches == 481


def test_missed_reports_are_raised():
    totals = StreamTotals(None).take([report(0)])
    with pytest.raises(RuntimeError, match="batches 1 to 4"):
        totals.take([report(5)])


def test_many_small_batches_are_all_counted(spark, tmp_path, land):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        run = Run(spark, tmp_path, Settings(max_files_per_trigger=1))
        for i in range(12):
            land(event(i), name=f"{i}.json")
        try:
            totals = run.to_bronze()
        except RuntimeError:
            return  # a gap may be raised, but nothing is left out silently
        assert (totals.batches, totals.records) == (12, 12)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


@pytest.mark.parametrize("limit", [1, 1_000_000])
@pytest.mark.parametrize("name", ["silver_stream", "stream_dedup", "late_data", "gold_stream", "stream_metrics"])
def test_results_do_not_depend_on_the_number_of_batches(spark, monkeypatch, name, limit):
    monkeypatch.setattr(verified, "STREAM", Settings(max_files_per_trigger=limit))
    rows = queries()[name](spark, SMALL).toPandas()
    assert compare(rows, connect(SMALL).execute(oracle_sql()[name]).df()) == "ok"


@pytest.mark.parametrize("salts", [0, 16])
def test_replays_are_dropped_across_restarts(run, land, salts):
    land(*[event(0)] * 10, event(1), name="a.json")
    run.to_bronze()
    run.to_silver(salts=salts)
    assert run.rows("silver").count() == 2
    land(event(0), event(1), event(2), name="b.json")
    run.to_bronze()
    run.to_silver(salts=salts)
    assert run.rows("silver").count() == 3


def test_rows_behind_the_watermark_are_late(run, land):
    """24 hours behind the newest event is late, a millisecond newer is not."""
    land(event(timestamp="2024-11-07T10:00:00Z"), name="now.json")
    run.to_bronze()
    run.to_silver()
    land(
        event(device_id="late", timestamp="2024-11-05T10:00:00Z"),
        event(device_id="edge", timestamp="2024-11-06T10:00:00Z"),
        event(device_id="in_time", timestamp="2024-11-06T10:00:00.001Z"),
        name="old.json",
    )
    run.to_bronze()
    query = run.to_silver()
    assert run.rows("bronze").count() == 4
    kept = {r.device_id for r in run.rows("silver").collect()}
    assert kept == {"unit-07", "in_time"}
    metrics = layer_metrics(totals_frame(run.spark, {"silver": query})).first()
    assert (metrics.records_processed, metrics.late_rows, metrics.errors) == (3, 2, 0)


def test_nothing_is_late_in_the_first_batch(run, land):
    land(event(timestamp="2024-11-07T10:00:00Z"), event(timestamp="2024-11-05T10:00:00Z"))
    run.to_bronze()
    run.to_silver()
    assert run.rows("silver").count() == 2


def test_silver_is_partitioned_by_event_date(run, land):
    land(event(timestamp="2024-11-05T10:00:00Z"), event(timestamp="2024-11-06T10:00:00Z"))
    run.to_bronze()
    run.to_silver()
    dates = run.spark.read.parquet(run.silver).select("event_date").distinct().count()
    assert dates == 2 and run.rows("silver").where("timestamp >= '2024-11-06'").count() == 1


def test_gold_stream_emits_closed_windows_only(run, land):
    land(*[event(m) for m in (0, 30, 60)], event(timestamp="2024-11-06T11:30:00Z"))
    run.to_bronze()
    run.to_silver()
    run.to_gold()
    streamed = run.spark.read.parquet(run.gold)
    assert [r.window_start.hour for r in streamed.collect()] == [10]
    batch = compute_device_summary(run.rows("silver")).where(F.hour("window_start") == 10)
    assert streamed.exceptAll(batch.where("to_date(window_start) = '2024-11-05'")).count() == 0


def test_a_failing_stream_is_reported(run, land, spark):
    land(event())
    run.to_bronze()
    run.config = Settings(optional_fields=("no_such_column",))
    with pytest.raises(Exception, match="no_such_column"):
        run.to_silver()


def test_throughput_is_measured(run, land):
    land(*[event(m, device_id=f"d{i}") for i in range(10) for m in range(100)])
    query = run.to_bronze()
    metrics = layer_metrics(totals_frame(run.spark, {"bronze": query})).first()
    assert metrics.records_processed == 1000 and metrics.batches_completed == 1
    assert metrics.records_per_second > 10
