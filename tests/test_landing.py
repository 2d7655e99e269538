from pyspark.sql import functions as F

from telestrata.schema import RAW_SCHEMA
from telestrata.sources.landing import add_ingestion_metadata, parse_lines, read_landing
from telestrata.sources.layers import read_layer, read_or_empty
from tests.conftest import event, lines


def stored(spark, land, tmp_path, *records):
    path = str(tmp_path / "bronze")
    add_ingestion_metadata(read_landing(spark, land(*records))).write.parquet(path)
    return spark.read.parquet(path)


def test_good_and_broken_records(spark, land, tmp_path):
    bronze = stored(spark, land, tmp_path, event(), "not json", '{"device_id": "x", ')
    assert bronze.count() == 3
    corrupt = {r[0] for r in bronze.select("_corrupt_record").where("_corrupt_record is not null").collect()}
    assert corrupt == {"not json", '{"device_id": "x", '}
    assert len(bronze.columns) == 11


def test_a_wrong_type_keeps_the_good_fields_of_a_file_record(spark, land, tmp_path):
    bad = '{"device_id": "d9", "timestamp": "2024-11-05T10:00:00Z", "temperature": "hot"}'
    row = stored(spark, land, tmp_path, bad).first()
    assert row._corrupt_record == bad
    assert (row.device_id, row.temperature) == ("d9", None)


def test_a_bad_timestamp_is_corrupt(spark, land, tmp_path):
    row = stored(spark, land, tmp_path, event(timestamp="yesterday")).first()
    assert row.timestamp is None and row._corrupt_record is not None


def test_unknown_fields_are_ignored(spark, land, tmp_path):
    bronze = stored(spark, land, tmp_path, event(rack=14, carrier="north"))
    assert "rack" not in bronze.columns
    assert bronze.first()._corrupt_record is None


def test_missing_keys_are_read_as_null(spark, land, tmp_path):
    row = stored(spark, land, tmp_path, event(device_id=None)).first()
    assert row.device_id is None and row._corrupt_record is None


def test_ingestion_columns(spark, land, tmp_path):
    row = stored(spark, land, tmp_path, event()).first()
    assert row._ingested_at is not None
    assert row._source_file.endswith("landing/batch.json")


def test_offsets_are_honoured(frame):
    row = frame(event(timestamp="2024-11-05T12:00:00+02:00")).first()
    assert str(row.timestamp) == "2024-11-05 10:00:00"


def test_parsing_text_gives_what_the_file_reader_gives(spark, land, tmp_path):
    records = (
        event(),
        "not json",
        '{"device_id": "d9", "temperature": "hot"}',
        event(timestamp="yesterday"),
    )
    from_files = stored(spark, land, tmp_path, *records).drop("_ingested_at", "_source_file")
    rows = spark.createDataFrame([(x,) for x in lines(*records)], "value string")
    assert parse_lines(rows).exceptAll(from_files).count() == 0
    assert from_files.count() == 4


def test_missing_layer_is_empty(spark, tmp_path):
    nothing = read_or_empty(spark, str(tmp_path / "nowhere"), RAW_SCHEMA)
    assert nothing.count() == 0 and nothing.columns == RAW_SCHEMA.fieldNames()


def test_bounds_select_date_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "dated")
    days = [event(timestamp=f"2025-06-0{d}T12:00:00Z") for d in (1, 2, 3)]
    frame(*days).withColumn("event_date", F.to_date("timestamp")).write.partitionBy(
        "event_date"
    ).parquet(path)
    some = read_layer(spark, path, since="2025-06-02", until="2025-06-03")
    assert some.count() == 1 and "event_date" not in some.columns
    assert read_layer(spark, path).count() == 3
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
