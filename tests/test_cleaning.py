from pyspark.sql import functions as F

from telestrata.operators import cleaning
from tests.conftest import event


def test_corrupt_rows_leave_and_so_does_the_column(frame):
    kept = cleaning.drop_corrupt_records(frame(event(), "nope", "{broken"))
    assert kept.count() == 1
    assert "_corrupt_record" not in kept.columns
    assert cleaning.drop_corrupt_records(kept).columns == kept.columns


def test_rows_without_a_key_leave(frame):
    df = frame(event(), event(device_id=None), event(timestamp=None), event(temperature=None))
    assert cleaning.drop_nulls(df).count() == 2
    assert cleaning.drop_nulls(df, ["temperature"]).count() == 3


def test_one_row_per_key(frame):
    df = frame(*[event()] * 10, event(1), event(device_id="unit-08"))
    assert cleaning.deduplicate(df).count() == 3


def test_same_key_with_other_payload_is_also_a_duplicate(frame):
    df = frame(event(temperature=20), event(temperature=21))
    assert cleaning.deduplicate(df).count() == 1


def test_first_of_a_key_is_the_earliest_then_the_lowest(spark):
    rows = [("a", 1, 2, "late"), ("a", 1, 1, "y"), ("a", 1, 1, "x"), ("b", 1, None, "only")]
    df = spark.createDataFrame(
        rows, "device_id string, timestamp int, _ingested_at int, payload string"
    )
    first = {r.device_id: r.payload for r in cleaning.deduplicate_first(df).collect()}
    assert first == {"a": "x", "b": "only"}
    assert cleaning.deduplicate_first(df).columns == df.columns


def test_a_missing_arrival_time_is_last(spark):
    rows = [("a", 1, None, "unknown"), ("a", 1, 5, "known")]
    df = spark.createDataFrame(
        rows, "device_id string, timestamp int, _ingested_at int, payload string"
    )
    assert cleaning.deduplicate_first(df).first().payload == "known"


def test_a_key_with_most_of_the_rows_shrinks_before_the_shuffle(spark):
    hot = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("device_id"),
        F.lit(1).alias("timestamp"),
        F.lit(7).alias("_ingested_at"),
    )
    for one_per_key in (cleaning.deduplicate, cleaning.deduplicate_first):
        result = one_per_key(hot)
        assert result.count() == 20_001
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan  # copies collapse inside each input partition


def test_bronze_only_columns_leave(frame):
    df = frame(event()).withColumn("_source_file", F.lit("f"))
    assert "_source_file" not in cleaning.enforce_schema(df).columns
