"""Small helpers that the operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import telestrata
from telestrata.sources.storage import workspace


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a missing id counts as ''."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def fresh(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` has it (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared working folder and read it back.

    Cuts the lineage with files that outlive an executor, and gives the optimizer
    the true size of the result, so that it broadcasts only what is small.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(lengths: np.ndarray, at_most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose lengths add up to ``at_most``; a longer row stands alone."""
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > at_most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def stretches(texts: pa.Array, at_most: int) -> Iterator[pa.Array]:
    """The texts of a batch, at most that many bytes at a time; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for a, b in slices(sizes, at_most):
        yield texts.slice(a, b - a)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix of every element (uint64 in, uint64 out)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_shipped: set[str] = set()

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = str(4 << 20)


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once per application, and return the session.

    Python workers then find the operators wherever they run. Unless the session says otherwise,
    rows go to them 4 MB at a time, not 10,000 rows of any length: both sides of the socket hold
    a batch in memory that they seldom give back.
    """
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="telestrata-package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        package = Path(telestrata.__file__).parent
        # Spark serves the archive from the driver, so it needn't be shared.
        archive = shutil.make_archive(f"{folder}/telestrata", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark
