"""Building and storing the four Gold tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telestrata.operators.windows import GOLD_TABLES, window_stats
from telestrata.settings import Settings
from telestrata.sources import snapshots
from telestrata.sources.storage import delete_folder, together, workspace


def build_and_write(
    silver: DataFrame, gold_path: str, config: Settings | Mapping | None = None
) -> dict[str, int]:
    """Replace every Gold table and return the rows written to each.

    Silver is read and shuffled once. The wide aggregate is written to the shared
    working folder rather than cached, so a lost executor costs the reread of
    some files and not a second pass over Silver.
    """
    settings = Settings.of(config)
    spark = silver.sparkSession
    staged_path = workspace(spark, "window-stats")
    staged = window_stats(silver, config=settings)

    def write(name: str) -> int:
        stats = spark.read.schema(staged.schema).parquet(staged_path)
        table = GOLD_TABLES[name](stats, settings)
        stamped = table.withColumn("_aggregated_at", F.current_timestamp())
        return snapshots.commit(stamped, f"{gold_path}/{name}").row_count

    try:
        staged.write.parquet(staged_path)
        # The tables do not depend on each other, so their jobs may overlap.
        return dict(zip(GOLD_TABLES, together(spark, write, GOLD_TABLES)))
    finally:
        delete_folder(spark, staged_path)


def read_gold(spark: SparkSession, gold_path: str, name: str) -> DataFrame:
    return snapshots.read_version(spark, f"{gold_path}/{name}")
