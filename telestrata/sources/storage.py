"""Shared working folders and the few file operations the tables need."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_folders: list[tuple[SparkSession, str]] = []


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach; it goes when the process ends.

    The cluster names the shared folder in ``spark.checkpoint.dir``; a folder set with
    ``setCheckpointDir`` counts too. Only a local session without either gets a temporary folder
    of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and hasattr(spark.sparkContext, "getCheckpointDir"):
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="telestrata-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if not _folders:
        atexit.register(_remove_folders)
    _folders.append((spark, path))
    return path


def _remove_folders() -> None:
    """Best effort: the session may have ended before."""
    for spark, path in _folders:
        with contextlib.suppress(Exception):
            delete_folder(spark, path)


def data_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Path and size of the Parquet files below ``paths``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(list(paths))
        .select("path", F.col("length").alias("num_bytes"))
    )


def together(spark: SparkSession, work: Callable, items: Iterable) -> list:
    """Results of ``work`` for a few items, in their order, with overlapping jobs.

    Every call is wrapped by itself: the wrapper copies Spark's local properties, and threads
    that share one copy clear each other's entries while queries start.
    """
    calls = [(inheritable_thread_target(spark)(work), item) for item in items]
    with ThreadPoolExecutor(max(1, len(calls))) as threads:
        return [done.result() for done in [threads.submit(call, item) for call, item in calls]]


def delete_folder(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).delete(hadoop_path, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).exists(hadoop_path)
