"""Layers that a stream writes batch by batch, as plain Parquet folders.

A micro-batch is one folder, a partition named by its number; a replay overwrites it. Compaction
writes the rows of neighbouring small batches once more, into a folder named by the first and the
last number. A folder counts once Spark
has marked it as complete, and stops counting when another complete one covers its batches. So the
names alone say what belongs to a layer: there is no log, a batch costs one name, and a reader
meets either the old folders or the new one. Superseded folders go when their retention ends.

Every row carries the number of its batch. A version is a batch number, and reading one is a
filter on that column, before and after compaction alike. One stream and one compaction at a time.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from telestrata.sources.layers import DATE_COLUMN
from telestrata.sources.storage import delete_folder

BATCH_COLUMN = "_batch_id"
TARGET_BYTES = 128 * 1024 * 1024
SEGMENT = "batch_segment"  # partition column of the folders
_DIGITS = 10
_NAME = re.compile(SEGMENT + r"=(\d+)(?:-(\d+))?")
SIZES = "folder string, first bigint, last bigint, num_files bigint, num_bytes bigint, written_at timestamp"


@dataclass(frozen=True, order=True)
class Segment:
    """A complete folder and the batches that it holds."""

    first: int
    last: int
    folder: str
    written_at: datetime

    def covers(self, other: Segment) -> bool:
        return self.first <= other.first and other.last <= self.last and self != other


def folder_name(first: int, last: int | None = None) -> str:
    """The folder of one batch, or of all from ``first`` to ``last``."""
    numbers = [first] if last is None else [first, last]
    return f"{SEGMENT}=" + "-".join(f"{n:0{_DIGITS}d}" for n in numbers)


def _complete(spark: SparkSession, path: str) -> list[Segment]:
    """All complete folders of a layer, from their names."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{SEGMENT}=*/_SUCCESS")
    files = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in files.globStatus(marks) or []:
        folder = status.getPath().getParent().getName()
        first, last = _NAME.fullmatch(folder).groups()
        time = datetime.fromtimestamp(status.getModificationTime() / 1000, timezone.utc)
        found.append(Segment(int(first), int(last or first), folder, time))
    return sorted(found)


def segments(spark: SparkSession, path: str) -> list[Segment]:
    """The folders that count, in order of their batches."""
    kept: list[Segment] = []
    for one in sorted(_complete(spark, path), key=lambda s: (s.first, -s.last, s.folder)):
        if not kept or one.last > kept[-1].last:
            kept.append(one)
    return kept


def superseded(spark: SparkSession, path: str) -> list[tuple[Segment, Segment]]:
    """Complete folders that no longer count, each with the one that replaced it."""
    counting = segments(spark, path)
    return [
        (one, next(c for c in counting if c.covers(one)))
        for one in _complete(spark, path)
        if one not in counting
    ]


def _write(rows: DataFrame, folder: str, files: int | None = None) -> None:
    """Write a folder as a whole. Rows of a date come together; skewed dates are split."""
    if DATE_COLUMN in rows.columns:
        rows.hint("rebalance", DATE_COLUMN).write.mode("overwrite").partitionBy(DATE_COLUMN).parquet(folder)
    else:
        (rows if files is None else rows.coalesce(files)).write.mode("overwrite").parquet(folder)


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write the rows of one micro-batch; the same number again replaces them."""
    numbered = rows.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long"))
    _write(numbered, f"{path}/{folder_name(batch_id)}")


def _rows(spark: SparkSession, path: str, of: Iterable[Segment]) -> DataFrame:
    """The rows of some folders with their batch and, where there is one, their date."""
    folders = [f"{path}/{s.folder}" for s in of]
    if not folders:
        raise ValueError(f"{path} holds no complete batch")
    reader = spark.read.option("basePath", path).option("mergeSchema", "true")
    return reader.parquet(*folders).drop(SEGMENT)


def read_batches(
    spark: SparkSession, path: str, upto: int | None = None, after: int | None = None, numbered: bool = False
) -> DataFrame:
    """The rows of a layer, optionally only of batches ``after < batch <= upto``.

    Folders outside the bounds aren't opened; in compacted ones the batch column decides.
    """
    low, high = -1 if after is None else after, math.inf if upto is None else upto
    wanted = [s for s in segments(spark, path) if s.first <= high and s.last > low]
    rows = _rows(spark, path, wanted)
    if after is not None:
        rows = rows.where(F.col(BATCH_COLUMN) > after)
    if upto is not None:
        rows = rows.where(F.col(BATCH_COLUMN) <= upto)
    return rows.drop(DATE_COLUMN) if numbered else rows.drop(DATE_COLUMN, BATCH_COLUMN)


def read_batch_stream(spark: SparkSession, path: str, schema: StructType, max_files: int = 100) -> DataFrame:
    """New batches of a layer as a stream; compacted folders are no news.

    A batch must stay until its readers have met it, so the retention must exceed their delay.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{path}/{SEGMENT}={'[0-9]' * _DIGITS}")


def sizes(spark: SparkSession, path: str, of: Iterable[Segment] | None = None) -> DataFrame:
    """``(folder, first, last, num_files, num_bytes, written_at)`` of each folder that counts."""
    of = segments(spark, path) if of is None else list(of)
    if not of:
        return spark.createDataFrame([], SIZES)
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load([f"{path}/{s.folder}" for s in of])
        .select(F.regexp_extract("path", _NAME.pattern, 0).alias("folder"), "length")
        .groupBy("folder")
        .agg(F.count(F.lit(1)).alias("num_files"), F.sum("length").alias("num_bytes"))
    )
    named = spark.createDataFrame(
        [(s.folder, s.first, s.last, s.written_at) for s in of],
        "folder string, first bigint, last bigint, written_at timestamp",
    )
    return named.join(listed, "folder", "left").select(
        "folder", "first", "last",
        F.coalesce("num_files", F.lit(0)).cast("long").alias("num_files"),
        F.coalesce("num_bytes", F.lit(0)).cast("long").alias("num_bytes"),
        "written_at",
    )


def batch_history(spark: SparkSession, path: str) -> DataFrame:
    """One row per folder that counts: its operation, batches, rows, files, bytes and time."""
    rows = read_batches(spark, path, numbered=True)
    counts = rows.groupBy(BATCH_COLUMN).agg(F.count(F.lit(1)).alias("n"))
    measured = sizes(spark, path)
    inside = (F.col(BATCH_COLUMN) >= F.col("first")) & (F.col(BATCH_COLUMN) <= F.col("last"))
    # One row per batch and one per folder.
    totals = measured.join(counts, inside, "left").groupBy("folder").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
    operation = F.when(F.col("folder").contains("-"), "COMPACT").otherwise("APPEND")
    return measured.join(totals, "folder").select(
        operation.alias("operation"), F.col("first").alias("first_batch"), F.col("last").alias("last_batch"),
        "row_count", "num_files", "num_bytes", "written_at",
    )


def _small_runs(measured: list, target_bytes: int) -> list[list]:
    """Runs of neighbouring folders that are small or cut into too many files."""
    runs, open_run = [], []
    for one in measured:
        needed = max(1, math.ceil(one.num_bytes / target_bytes))
        if one.num_bytes < target_bytes / 2 or one.num_files >= 2 * needed:
            open_run.append(one)
            continue
        runs.append(open_run)
        open_run = []
    return [r for r in [*runs, open_run] if r]


def compact_batches(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> list[Segment]:
    """Write neighbouring small folders as one; large folders between them stay as they are.

    Returns the new folders. What they replace stays readable for streams until it expires.
    """
    known = {s.folder: s for s in segments(spark, path)}
    # One row per folder, like the listing of names.
    measured = sorted(sizes(spark, path, known.values()).collect(), key=lambda r: r.first)
    new = []
    for run in _small_runs(measured, target_bytes):
        total = sum(r.num_bytes for r in run)
        files = max(1, math.ceil(total / target_bytes))
        if sum(r.num_files for r in run) <= files:
            continue
        folder = folder_name(run[0].first, run[-1].last)
        if folder == run[0].folder:
            continue  # dates already part the rows into these files
        _write(_rows(spark, path, [known[r.folder] for r in run]), f"{path}/{folder}", files)
        new.append(folder)
    return [s for s in segments(spark, path) if s.folder in new]


def expire_batches(
    spark: SparkSession, path: str, retention_hours: float, now: datetime | None = None
) -> list[str]:
    """Delete folders that were superseded more than ``retention_hours`` ago; zero keeps all.

    No row goes: every batch stays in the folder that covers it.
    """
    if retention_hours <= 0:
        return []
    limit = (now or datetime.now(timezone.utc)) - timedelta(hours=retention_hours)
    gone = [one.folder for one, by in superseded(spark, path) if by.written_at < limit]
    for folder in gone:
        delete_folder(spark, f"{path}/{folder}")
    return gone
