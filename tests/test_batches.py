"""Layers written by foreachBatch: restart, replay, time travel, compaction and retention."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from tests.conftest import event, lines
from telestrata.plans.maintenance import maintain_batches
from telestrata.settings import Settings
from telestrata.sources import batches
from telestrata.streaming.jobs import start_bronze, start_silver
from telestrata.streaming.sinks import drained
from tests.conftest import event, lines

ONE_FILE = Settings(max_files_per_trigger=1)
LATER = datetime.now(timezone.utc) + timedelta(days=90)


def land(folder: Path, name: str, *records) -> None:
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(lines(*records)) + "\n")


def flow(spark, at: Path) -> None:
    drained(start_bronze(spark, f"{at}/in", f"{at}/bronze", f"{at}/c/bronze", ONE_FILE, True, by_batch=True))
    drained(start_silver(spark, f"{at}/bronze", f"{at}/silver", f"{at}/c/silver", ONE_FILE, True, by_batch=True))


def minutes(df) -> list[int]:
    return sorted(r.timestamp.minute for r in df.collect())


def test_restart_travel_and_maintenance(spark, tmp_path):
    for i in range(4):
        land(tmp_path / "in", f"a{i}", event(i), event(i), "torn")
    flow(spark, tmp_path)
    land(tmp_path / "in", "b", event(9), event(0))
    flow(spark, tmp_path)
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    assert [s.folder for s in batches.segments(spark, bronze)] == [batches.folder_name(i) for i in range(5)]
    assert batches.read_batches(spark, bronze).count() == 14
    assert minutes(batches.read_batches(spark, silver)) == [0, 1, 2, 3, 9]
    versions = {n: batches.read_batches(spark, bronze, upto=n).count() for n in range(5)}
    assert versions == {0: 3, 1: 6, 2: 9, 3: 12, 4: 14}

    history = batches.batch_history(spark, bronze).orderBy("first_batch").collect()
    assert [(r.operation, r.first_batch, r.row_count) for r in history] == [("APPEND", i, n) for i, n in enumerate([3, 3, 3, 3, 2])]
    assert all(r.num_files > 0 and r.num_bytes > 0 for r in history)

    policy = Settings(optimize_enabled=True, vacuum_enabled=True)
    layers = {"Bronze": bronze, "Silver": silver}
    first = {(r.layer, r.action): (r.status, r.files_changed) for r in maintain_batches(spark, layers, policy).collect()}
    assert first["Bronze", "compact"] == ("compacted", 1) and first["Bronze", "expire"] == ("expired", 0)
    assert [s.folder for s in batches.segments(spark, bronze)] == [batches.folder_name(0, 4)]
    # The stream goes on while old batches are still there, and after they have gone.
    land(tmp_path / "in", "c", event(10))
    flow(spark, tmp_path)
    swept = maintain_batches(spark, layers, policy, now=LATER).where("action = 'expire'").collect()
    assert all(r.files_changed >= 5 for r in swept)
    land(tmp_path / "in", "d", event(11))
    flow(spark, tmp_path)
    assert minutes(batches.read_batches(spark, silver)) == [0, 1, 2, 3, 9, 10, 11]
    assert {n: batches.read_batches(spark, bronze, upto=n).count() for n in range(5)} == versions
    assert batches.read_batches(spark, bronze, after=4).count() == 2
    summed = batches.batch_history(spark, bronze).agg({"row_count": "sum"}).first()[0]
    assert summed == batches.read_batches(spark, bronze).count() == 16


def test_replayed_batch_replaces_itself(spark, tmp_path):
    for i in range(3):
        land(tmp_path / "in", f"a{i}", event(i))
    run = lambda: drained(start_bronze(spark, f"{tmp_path}/in", f"{tmp_path}/bronze", f"{tmp_path}/c", ONE_FILE, True, by_batch=True))
    run()
    (tmp_path / "c" / "commits" / "2").unlink()  # as if the driver had died after writing batch 2
    (tmp_path / "c" / "commits" / ".2.crc").unlink(missing_ok=True)
    run()
    assert minutes(batches.read_batches(spark, f"{tmp_path}/bronze")) == [0, 1, 2]
    # A replay of a batch that was compacted since stays covered.
    batches.compact_batches(spark, f"{tmp_path}/bronze")
    (tmp_path / "c" / "commits" / "2").unlink()
    (tmp_path / "c" / "commits" / ".2.crc").unlink(missing_ok=True)
    run()
    assert minutes(batches.read_batches(spark, f"{tmp_path}/bronze")) == [0, 1, 2]


def test_unfinished_folders_do_not_count(spark, tmp_path):
    for i in range(3):
        batches.write_batch(spark.createDataFrame([(i,)], "x int"), f"{tmp_path}/t", i)
    batches.compact_batches(spark, f"{tmp_path}/t")
    (tmp_path / "t" / batches.folder_name(0, 2) / "_SUCCESS").unlink()
    assert [s.folder for s in batches.segments(spark, f"{tmp_path}/t")] == [batches.folder_name(i) for i in range(3)]
    assert batches.read_batches(spark, f"{tmp_path}/t").count() == 3
    with pytest.raises(ValueError, match="no complete batch"):
        batches.read_batches(spark, f"{tmp_path}/none")


def test_large_files_stay_beside_small_ones(spark, tmp_path):
    path = f"{tmp_path}/t"
    wide = spark.range(20_000).selectExpr("id as x", "sha2(string(id), 256) as pad")
    for i, rows in enumerate([wide.limit(3), wide.limit(2), wide.coalesce(1), wide.limit(5), wide.limit(1)]):
        batches.write_batch(rows, path, i)
    large = tmp_path / "t" / batches.folder_name(2)
    before = {p.name: p.stat().st_mtime_ns for p in large.iterdir()}
    done = batches.compact_batches(spark, path, target_bytes=1_000_000)
    assert [(s.first, s.last) for s in done] == [(0, 1), (3, 4)]
    assert [(s.first, s.last) for s in batches.segments(spark, path)] == [(0, 1), (2, 2), (3, 4)]
    assert {p.name: p.stat().st_mtime_ns for p in large.iterdir()} == before
    assert batches.read_batches(spark, path).count() == 20_011
    assert batches.compact_batches(spark, path, target_bytes=1_000_000) == []


def test_fifty_batches_cost_fifty_names(spark, tmp_path):
    path = tmp_path / "t"
    one = spark.createDataFrame([(1,)], "x int").coalesce(1)
    for i in range(50):
        batches.write_batch(one, str(path), i)
    assert sorted(p.name for p in path.iterdir()) == [batches.folder_name(i) for i in range(50)]
    [merged] = batches.compact_batches(spark, str(path))
    assert merged.folder == batches.folder_name(0, 49) and batches.read_batches(spark, str(path), upto=9).count() == 10
    assert len(batches.expire_batches(spark, str(path), 1, LATER)) == 50
    assert batches.expire_batches(spark, str(path), 0, LATER) == []
    assert json.loads(batches.read_batches(spark, str(path)).toJSON().first()) == {"x": 1}


def test_columns_that_come_later(spark, tmp_path):
    path = f"{tmp_path}/t"
    batches.write_batch(spark.createDataFrame([(1,)], "x int"), path, 0)
    batches.write_batch(spark.createDataFrame([(2, "a")], "x int, y string"), path, 1)
    rows = lambda: sorted((r.x, r.y) for r in batches.read_batches(spark, path).collect())
    assert rows() == [(1, None), (2, "a")]
    batches.compact_batches(spark, path)
    assert rows() == [(1, None), (2, "a")]
