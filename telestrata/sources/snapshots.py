"""Tables with versions on plain Parquet.

A table folder holds one data folder per write and a ``history`` of JSON rows. A
history row names the data folders and the columns of its version, so an append
adds a folder without rewriting the older ones, and any version can be read later
without looking into file footers for its schema. The row is written last: a
version without a row does not exist. One writer at a time.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from telestrata.sources.storage import data_files, delete_folder

HISTORY_SCHEMA = (
    "version bigint, committed_at timestamp, operation string, "
    "row_count bigint, num_files bigint, num_bytes bigint, folders array<string>, "
    "columns string"
)
REMOVAL = "EXPIRE"  # rows of this operation list folders that are gone


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per operation, oldest first; no rows for a table never written."""
    try:
        log = spark.read.schema(HISTORY_SCHEMA).json(f"{path}/history")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], HISTORY_SCHEMA)
    return log.orderBy("version", "committed_at")


def _versions(spark: SparkSession, path: str) -> tuple[list[Row], set[str]]:
    """Committed versions and the folders that were removed (table metadata)."""
    rows = history(spark, path).collect()
    gone = {f for r in rows if r.operation == REMOVAL for f in r.folders}
    return [r for r in rows if r.operation != REMOVAL], gone


def commit(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    operation: str | None = None,
    keep: Sequence[str] = (),
) -> Row:
    """Write ``df`` as the next version and return its history row.

    ``append`` keeps the rows of the last version, ``overwrite`` replaces them but for
    those in the folders ``keep``.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    versions, _ = _versions(spark, path)
    version = versions[-1].version + 1 if versions else 0
    folder = f"data/{version:06d}-{uuid.uuid4().hex[:8]}"
    appended = bool(versions) and mode == "append"
    before = StructType.fromJson(json.loads(versions[-1].columns)) if appended else None
    columns = _widened(before, df.schema) if appended else df.schema
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("row_count"))
    counted.write.parquet(f"{path}/{folder}")
    size = data_files(spark, f"{path}/{folder}").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("num_bytes"), F.lit(0)).alias("b")
    ).first()
    kept = list(versions[-1].folders) if appended else list(keep)
    return _log(
        spark,
        path,
        version,
        operation or mode.upper(),
        (written.get["row_count"], size.n, size.b),
        [*kept, folder],
        columns.json(),
    )


def _widened(before: StructType, new: StructType) -> StructType:
    """The old columns and then the added ones; a changed type is refused."""
    known = {f.name: f.dataType for f in before}
    for f in new:
        if known.get(f.name, f.dataType) != f.dataType:
            raise ValueError(
                f"column {f.name} is {known[f.name].simpleString()} in the table "
                f"and {f.dataType.simpleString()} in the new rows"
            )
    added = [f for f in new if f.name not in known]
    return StructType([*before.fields, *added])


def _log(spark, path, version, operation, amounts, folders, columns) -> Row:
    entry = Row(
        version=version,
        committed_at=datetime.now(timezone.utc),
        operation=operation,
        row_count=amounts[0],
        num_files=amounts[1],
        num_bytes=amounts[2],
        folders=folders,
        columns=columns,
    )
    one = spark.range(1, numPartitions=1).select(
        *[F.lit(value).alias(name) for name, value in entry.asDict().items()]
    )
    one.write.mode("append").json(f"{path}/history")
    return entry


def read_version(
    spark: SparkSession, path: str, version: int | None = None
) -> DataFrame:
    """Rows of one version (default: the last). Columns added by later appends
    are null in the older rows."""
    versions, gone = _versions(spark, path)
    wanted = [r for r in versions if version is None or r.version == version]
    if not wanted:
        raise ValueError(f"{path} has no version {version}")
    folders = wanted[-1].folders
    if gone.intersection(folders):
        raise ValueError(f"version {version} of {path} has expired")
    columns = StructType.fromJson(json.loads(wanted[-1].columns))
    return spark.read.schema(columns).parquet(*[f"{path}/{f}" for f in folders])


def unshared(spark: SparkSession, path: str, old: int, new: int) -> tuple[DataFrame, DataFrame]:
    """Two versions without the folders that both hold, for comparing them."""
    versions, _ = _versions(spark, path)
    folders = {r.version: r.folders for r in versions}
    shared = set(folders[old]) & set(folders[new])
    sides = []
    for version in (old, new):
        rows = read_version(spark, path, version)
        own = [f"{path}/{f}" for f in folders[version] if f not in shared]
        sides.append(spark.read.schema(rows.schema).parquet(*own) if own else rows.limit(0))
    return sides[0], sides[1]


def _folder_of(file: Column) -> Column:
    """The data folder of a file of a table, as history rows name it."""
    return F.regexp_extract(file, r"data/[^/]+", 0)


def rows_by_version(spark: SparkSession, path: str) -> DataFrame:
    """Row count of every readable version and the rows added since the first.

    Every folder is counted once, however many versions hold it.
    """
    versions, gone = _versions(spark, path)
    readable = [r for r in versions if not gone.intersection(r.folders)]
    parts = [(r.version, f) for r in readable for f in r.folders]
    held = spark.createDataFrame(parts, "version bigint, folder string")
    columns = StructType.fromJson(json.loads(readable[-1].columns))
    rows = spark.read.schema(columns).parquet(*sorted({f"{path}/{f}" for _, f in parts}))
    counts = rows.groupBy(_folder_of(F.input_file_name()).alias("folder")).count()
    totals = held.join(counts, "folder", "left").groupBy("version").agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("row_count")
    )
    # One row per version.
    first = F.first("row_count").over(Window.orderBy("version"))
    return totals.withColumn("added_since_first", F.col("row_count") - first)


def merged_history(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """History of several tables in order of time, tagged with the table name."""
    merged = None
    for name, path in tables.items():
        one = history(spark, path).drop("folders", "columns").withColumn("table", F.lit(name))
        merged = one if merged is None else merged.unionByName(one)
    return merged.orderBy("committed_at", "table", "version")


def compact(
    spark: SparkSession, path: str, target_bytes: int = 128 * 1024 * 1024
) -> Row | None:
    """Rewrite the small files of the last version into files of about ``target_bytes``.

    A folder all of whose files have at least half the target stays as it is, and the new version
    refers to it. The scan packs small files into partitions, and ``coalesce`` merges
    partitions without a shuffle. Returns ``None`` if there is nothing to gain.
    """
    versions, _ = _versions(spark, path)
    current = versions[-1]
    sizes = (
        data_files(spark, *[f"{path}/{f}" for f in current.folders])
        .groupBy(_folder_of(F.col("path")).alias("folder"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("num_bytes").alias("b"), F.min("num_bytes").alias("least"))
        .collect()  # one row per folder, like the history row
    )
    small = {r.folder: r for r in sizes if r.least < target_bytes / 2}
    files = max(1, math.ceil(sum(r.b for r in small.values()) / target_bytes))
    if sum(r.n for r in small.values()) <= files:
        return None
    columns = StructType.fromJson(json.loads(current.columns))
    rows = spark.read.schema(columns).parquet(*[f"{path}/{f}" for f in small])
    kept = [f for f in current.folders if f not in small]
    return commit(rows.coalesce(files), path, "overwrite", "COMPACT", kept)


def expire(
    spark: SparkSession,
    path: str,
    retention_hours: float,
    now: datetime | None = None,
) -> list[str]:
    """Remove the data of versions replaced more than ``retention_hours`` ago.

    Zero or less keeps everything. The last version always stays. The removal is
    logged before the folders go, so a reader never meets a half-removed version.
    """
    if retention_hours <= 0:
        return []
    now = now or datetime.now(timezone.utc)
    limit = (now - timedelta(hours=retention_hours)).timestamp()
    versions, gone = _versions(spark, path)
    replaced_at = [r.committed_at.timestamp() for r in versions[1:]]
    kept = [r for r, t in zip(versions, [*replaced_at, float("inf")]) if t >= limit]
    needed = {f for r in kept for f in r.folders}
    stale = sorted({f for r in versions for f in r.folders} - needed - gone)
    if stale:
        files = data_files(spark, *[f"{path}/{f}" for f in stale]).agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("num_bytes"), F.lit(0)).alias("b")
        ).first()
        last = versions[-1]
        amounts = (0, files.n, files.b)
        _log(spark, path, last.version, REMOVAL, amounts, stale, last.columns)
        for folder in stale:
            delete_folder(spark, f"{path}/{folder}")
    return stale
