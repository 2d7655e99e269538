"""What a streaming sink leaves on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telestrata.sources.storage import data_files


def check_stream_storage(
    spark: SparkSession, layer: str, path: str, checkpoint: str
) -> DataFrame:
    """Data files, planned batches and committed batches of one stream.

    Every planned batch must be committed, which holds once a stream has drained.
    """
    listed = data_files(spark, path).select(F.lit("files").alias("kind"))
    for kind in ("offsets", "commits"):
        log = spark.read.format("binaryFile").load(f"{checkpoint}/{kind}")
        listed = listed.unionByName(
            log.where(F.col("path").rlike(r"/\d+$")).select(F.lit(kind).alias("kind"))
        )
    kinds = {k: F.count_if(F.col("kind") == k) for k in ("files", "offsets", "commits")}
    found = listed.agg(*[c.alias(k) for k, c in kinds.items()])

    def verdict(kind: str, passed, expected: str):
        return F.struct(
            F.lit(f"{kind} exist").alias("check"),
            F.lit(layer).alias("layer"),
            F.when(passed, "pass").otherwise("fail").alias("status"),
            F.col(kind).cast("double").alias("observed"),
            F.lit(expected).alias("expected"),
        )

    return found.select(
        F.inline(
            F.array(
                verdict("files", F.col("files") > 0, "> 0"),
                verdict("offsets", F.col("offsets") > 0, "> 0"),
                verdict("commits", F.col("commits") == F.col("offsets"), "= offsets"),
            )
        )
    )
