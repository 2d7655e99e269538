import threading
from datetime import datetime, timedelta, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from telestrata.operators.windows import GOLD_TABLES
from telestrata.plans.gold import build_and_write, read_gold
from telestrata.plans.maintenance import run_maintenance, snapshot_streamed_layer
from telestrata.plans.silver import apply_transformations
from telestrata.settings import Settings
from telestrata.sources import snapshots
from telestrata.sources.storage import data_files, folder_exists, together, workspace
from tests.vectors import plain_gold, plain_silver, random_feed


def numbers(spark, low, high, files=1):
    return spark.range(low, high, numPartitions=files)


def test_append_and_read_any_version(spark, tmp_path):
    path = str(tmp_path / "t")
    for low in (0, 10, 20):
        snapshots.commit(numbers(spark, low, low + 10), path, "append")
    assert [snapshots.read_version(spark, path, v).count() for v in (0, 1, 2)] == [10, 20, 30]
    assert snapshots.read_version(spark, path).count() == 30
    rows = snapshots.rows_by_version(spark, path).orderBy("version").collect()
    assert [(r.row_count, r.added_since_first) for r in rows] == [(10, 0), (20, 10), (30, 20)]
    with pytest.raises(ValueError, match="no version 7"):
        snapshots.read_version(spark, path, 7)


def test_overwrite_replaces_and_keeps_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.commit(numbers(spark, 0, 10), path)
    snapshots.commit(numbers(spark, 0, 3), path)
    assert snapshots.read_version(spark, path).count() == 3
    assert snapshots.read_version(spark, path, 0).count() == 10


def test_history(spark, tmp_path):
    path = str(tmp_path / "t")
    assert snapshots.history(spark, path).count() == 0
    snapshots.commit(numbers(spark, 0, 10, files=4), path, "append")
    snapshots.commit(numbers(spark, 0, 5), path, operation="LOAD")
    rows = snapshots.history(spark, path).collect()
    assert [(r.version, r.operation, r.row_count, r.num_files) for r in rows] == [
        (0, "APPEND", 10, 4),
        (1, "LOAD", 5, 1),
    ]
    assert all(r.num_bytes > 0 for r in rows)
    assert rows[0].committed_at <= rows[1].committed_at


def test_a_write_without_a_history_row_does_not_exist(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.commit(numbers(spark, 0, 10), path, "append")
    numbers(spark, 0, 99).write.parquet(f"{path}/data/000001-interrupted")
    assert snapshots.read_version(spark, path).count() == 10
    snapshots.commit(numbers(spark, 10, 12), path, "append")
    assert snapshots.read_version(spark, path).count() == 12


def test_columns_may_be_added(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.commit(numbers(spark, 0, 2), path, "append")
    snapshots.commit(numbers(spark, 2, 3).withColumn("extra", F.lit("x")), path, "append")
    rows = {r.id: r.extra for r in snapshots.read_version(spark, path).collect()}
    assert rows == {0: None, 1: None, 2: "x"}


def test_a_changed_type_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.commit(numbers(spark, 0, 2), path, "append")
    with pytest.raises(ValueError, match="id is bigint in the table and string"):
        snapshots.commit(numbers(spark, 0, 1).select(F.col("id").cast("string")), path, "append")
    assert snapshots.read_version(spark, path).count() == 2


def test_merged_history_is_ordered_by_time(spark, tmp_path):
    tables = {n: str(tmp_path / n) for n in ("a", "b")}
    for name in ("a", "b", "a"):
        snapshots.commit(numbers(spark, 0, 1), tables[name], "append")
    rows = snapshots.merged_history(spark, tables).collect()
    assert [(r.table, r.version) for r in rows] == [("a", 0), ("b", 0), ("a", 1)]


def test_compaction_keeps_the_rows_and_shuffles_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for low in range(0, 30, 10):
        snapshots.commit(numbers(spark, low, low + 10, files=3), path, "append")
    done = snapshots.compact(spark, path)
    assert (done.operation, done.num_files, done.row_count) == ("COMPACT", 1, 30)
    assert snapshots.read_version(spark, path).count() == 30
    assert snapshots.compact(spark, path) is None


def test_retention(spark, tmp_path):
    path = str(tmp_path / "t")
    for low in range(0, 30, 10):
        snapshots.commit(numbers(spark, low, low + 10), path, "append")
    snapshots.compact(spark, path)
    later = datetime.now(timezone.utc) + timedelta(hours=5)
    assert snapshots.expire(spark, path, 0, now=later) == []
    assert snapshots.expire(spark, path, 24, now=later) == []
    removed = snapshots.expire(spark, path, 1, now=later)
    assert len(removed) == 3
    assert not any(folder_exists(spark, f"{path}/{f}") for f in removed)
    assert snapshots.read_version(spark, path).count() == 30
    with pytest.raises(ValueError, match="expired"):
        snapshots.read_version(spark, path, 0)
    assert snapshots.rows_by_version(spark, path).count() == 1
    assert snapshots.expire(spark, path, 1, now=later) == []
    snapshots.commit(numbers(spark, 30, 31), path, "append")
    assert snapshots.read_version(spark, path).count() == 31


def test_retention_spares_folders_that_later_versions_share(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.commit(numbers(spark, 0, 10), path, "append")
    snapshots.commit(numbers(spark, 10, 20), path, "append")
    later = datetime.now(timezone.utc) + timedelta(hours=5)
    assert snapshots.expire(spark, path, 1, now=later) == []
    assert snapshots.read_version(spark, path).count() == 20


def test_compaction_leaves_large_files_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.commit(numbers(spark, 0, 100_000).repartition(1), path)
    large = snapshots.read_version(spark, path).inputFiles()
    size = sum(r.num_bytes for r in data_files(spark, path).collect())
    for i in range(3):
        snapshots.commit(numbers(spark, 100_000 + i, 100_001 + i), path, "append")
    assert snapshots.compact(spark, path, target_bytes=size).num_files == 1
    after = snapshots.read_version(spark, path)
    assert set(large) < set(after.inputFiles()) and len(after.inputFiles()) == 2
    assert after.count() == 100_003
    assert snapshots.compact(spark, path, target_bytes=size) is None


def test_compaction_packs_small_files_beside_a_large_one(spark, tmp_path):
    path = str(tmp_path / "t")
    large = numbers(spark, 0, 100_000).repartition(1)
    snapshots.commit(large.union(numbers(spark, 100_000, 100_009, files=9)), path)
    size = max(r.num_bytes for r in data_files(spark, path).collect())
    done = snapshots.compact(spark, path, target_bytes=size // 5)
    assert done is not None and done.num_files < 10
    assert snapshots.read_version(spark, path).count() == 100_009


def test_gold_build_is_repeatable(spark, frame, tmp_path):
    silver = apply_transformations(frame(*random_feed()))
    root, n = str(tmp_path / "gold"), len(plain_gold(plain_silver(random_feed())))
    for _ in range(2):
        assert build_and_write(silver, root) == {t: n for t in GOLD_TABLES}
    for name in GOLD_TABLES:
        table = read_gold(spark, root, name)
        assert table.count() == n and table.columns[-1] == "_aggregated_at"
        assert snapshots.history(spark, f"{root}/{name}").count() == 2


def test_maintenance_follows_the_policy_of_each_layer(spark, frame, tmp_path):
    silver = apply_transformations(frame(*random_feed()))
    streamed = str(tmp_path / "streamed")
    silver.repartition(3).write.parquet(streamed)
    raw, clean, root = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    snapshot_streamed_layer(spark, streamed, raw)
    snapshots.commit(silver.repartition(3), clean)
    build_and_write(silver, root)
    nothing = run_maintenance(spark, raw, clean, root)
    assert nothing.count() == 0
    both = Settings(optimize_enabled=True, vacuum_enabled=True)
    rows = {(r.layer, r.action): r.status for r in run_maintenance(spark, raw, clean, root, both).collect()}
    assert rows[("Silver", "compact")] == "compacted"
    assert rows[("Silver", "expire")] == "expired"
    assert rows[("Gold/device_health", "expire")] == "kept forever"
    assert len(rows) == 12


def test_overlapping_calls_have_local_properties_of_their_own(spark):
    meet, context = threading.Barrier(3, timeout=30), spark.sparkContext

    def work(name):
        context.setLocalProperty("telestrata.call", name)
        meet.wait()
        return context.getLocalProperty("telestrata.call")

    assert together(spark, work, "abc") == ["a", "b", "c"]


def test_tables_are_maintained_together(spark, monkeypatch):
    meet = threading.Barrier(2 + len(GOLD_TABLES), timeout=30)
    monkeypatch.setattr(snapshots, "compact", lambda *_: (meet.wait(), None)[1])
    rows = run_maintenance(spark, "bronze", "silver", "gold", Settings(optimize_enabled=True)).collect()
    assert [r.layer for r in rows] == ["Bronze", "Silver", *[f"Gold/{name}" for name in GOLD_TABLES]]


def test_working_folders_are_fresh(spark):
    assert workspace(spark, "x") != workspace(spark, "x")


def session_like(master, **conf):
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_working_folders_follow_the_session(tmp_path):
    shared = session_like("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://shared/tmp/"})
    assert workspace(shared, "x").startswith("hdfs://shared/tmp/x-")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace(session_like("yarn"), "x")
